import random

from pyspark.sql import functions as F

from quire.operators import index
from quire.operators.index import dense_index, range_rank


def expected(rows, key):
    """Row number within the first column by the second, nulls first."""
    seen, out = {}, []
    for r in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r)):
        out.append((*r, seen.get(r[0], 0)))
        seen[r[0]] = seen.get(r[0], 0) + 1
    return sorted(out, key=key)


def test_range_rank_with_hot_groups_keys_and_nulls(spark):
    r = random.Random(1)
    rows = [(r.choice([None, "a", "hot", "hot", "hot", "é"]), r.choice([None, 1, r.randrange(500)])) for _ in range(3000)]
    key = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
    df = spark.createDataFrame(rows, "g string, k long").repartition(5)
    ranked = range_rank(df, ["g"], ["k"])
    assert sorted(map(tuple, ranked.collect()), key=key) == expected(rows, key)
    assert not range_rank(df.limit(0), ["g"], ["k"]).collect()
    alone = range_rank(df.select("k"), [], ["k"])
    got = sorted(map(tuple, alone.collect()), key=lambda x: x[1])
    assert [i for _, i in got] == list(range(3000)) and [k for k, _ in got] == sorted((k for _, k in rows), key=lambda v: (v is not None, v or 0))


def test_range_rank_spreads_one_repeated_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "scratch_path", lambda *_: f"{tmp_path}/ranked")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit("one").alias("g"), F.lit(None).cast("long").alias("k"), "id")
        ranked = range_rank(df, ["g"], ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [x["count"] for x in spark.read.parquet(f"{tmp_path}/ranked").groupBy("_part").count().collect()]
    assert len(parts) > 4 and max(parts) < 1500
    assert sorted(x.idx for x in ranked.collect()) == list(range(4000))


def test_tree_of_totals_has_no_window_over_everything(spark):
    """Several levels: eight ranges of 200 buckets, three children a node."""
    r = random.Random(3)
    rows = [(r.randrange(200), r.randrange(4000), r.randrange(5)) for _ in range(600)] + [(None, 1, 2), (None, None, 3)]
    rows = list({x[:2]: x for x in rows}.values())
    df = spark.createDataFrame(rows, "a long, b long, size long").repartition(3)
    key = lambda x: tuple((v is not None, v or 0) for v in x[:2])
    want, total = [], 0
    for i, x in enumerate(sorted(rows, key=key)):
        want.append((*x, i, total))
        total += x[2]
    for fanout in (3, 10_000):
        out = dense_index(df, ["a", "b"], size="size", offset_col="at", group_rows_col="n", group_size_col="s", fanout=fanout)
        got = sorted((tuple(x[c] for c in ("a", "b", "size", "idx", "at")) for x in out.collect()), key=lambda x: x[3])
        assert got == want and out.select("n", "s").distinct().collect() == [(len(rows), total)]
    assert not dense_index(df.limit(0), ["a", "b"]).collect()
