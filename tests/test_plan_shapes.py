"""Physical plan shapes the scale design relies on: no window
without a partition spec over payload rows, no Cartesian products, pruned
scans, broadcasts only where bounded."""
import re

import pytest

from quire.operators import dataset as ds
from quire.operators import index, infer
from quire.plans import catalog as C

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned_windows(p: str) -> list[str]:
    # "Window [exprs], [partition spec], [order spec]" with an empty partition spec
    return [line for line in p.splitlines() if re.search(r"Window \[.*\], \[\], \[", line)]


def test_pack_plan(spark):
    p = plan(C.cp_blocks(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert not unpartitioned_windows(p)
    scans = [l for l in p.splitlines() if "FileScan parquet" in l]
    assert scans and all("lang" not in l and "n_chars" not in l for l in scans)   # column pruning


@pytest.mark.parametrize("name", ["batch_rows", "export_shards", "prediction_record", "concat_sources", "batch_generate"])
def test_no_window_over_all_rows(spark, name, monkeypatch):
    """Neither in the query nor in the tree of totals behind its index."""
    seen, real = [], index.tree_bases

    def watched(*a):
        out = real(*a)
        seen.append(plan(out))
        return out

    monkeypatch.setattr(index, "tree_bases", watched)
    seen.append(plan(C.QUERIES[name](spark, SF)))
    assert len(seen) > 1 and any("Window" in p for p in seen)
    assert not [w for p in seen for w in unpartitioned_windows(p)] and "CartesianProduct" not in seen[-1]


def test_split_plan(spark):
    p = plan(C.split_blocks(spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p      # bucket table (<= 65,536 rows)
    # the only global (unpartitioned) windows run over the bounded bucket table
    for line in unpartitioned_windows(p):
        assert "_ps" in line


def test_turn_pairs_is_a_join_not_a_window_over_conversations(spark):
    p = plan(infer.turn_pairs(C.conversations(spark, SF)))
    assert "Window" not in p and "Join" in p
    gaps = plan(C.q_turn_pairs(spark, SF))
    assert "Join" in gaps and not unpartitioned_windows(gaps)


def test_parts_without_a_name(spark):
    parts = [(name, spark.createDataFrame([(i,)], "i long")) for i, name in enumerate(["b", None, "a"])]
    rows = ds.concat_sources(parts, order=["i"]).orderBy("row_idx").collect()
    assert [(r.part, r.i) for r in rows] == [(None, 1), ("a", 2), ("b", 0)]


def test_bigram_scoring_is_preaggregated(spark):
    df = C.q_perplexity(spark, SF)
    p = plan(df)
    assert "CartesianProduct" not in p
    assert "partial_count" in p or "HashAggregate" in p


def test_last_wins_partial_aggregation(spark):
    p = plan(C.q_last_wins(spark, SF))
    assert "partial_max_by" in p or "partial_" in p
