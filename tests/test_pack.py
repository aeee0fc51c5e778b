"""Ordering primitive and packing against plain Python."""
import random

import pytest
from pyspark.sql import functions as F

from quire.operators.index import dense_index
from quire.operators.pack import accounting, effective_block_size, pack

SCHEMA = "source string, idx bigint, input_ids array<int>"


def token_rows(seed=1):
    rng = random.Random(seed)
    rows = [("a", 0, []), ("a", 1, [5]), ("a", 2, list(range(100, 108))),      # empty, one, exactly one block (B=8)
            ("a", 3, list(range(200, 231))),                                  # several blocks
            ("tiny", 0, [1, 2, 3]),                                           # fewer than one block
            ("void", 0, [])]                                                  # empty source
    for i in range(4, 60):                                                    # a hot source
        rows.append(("a", i, [rng.randrange(1000) for _ in range(rng.randrange(0, 30))]))
    for i in range(25):
        rows.append(("b", i * 3, [rng.randrange(1000) for _ in range(rng.randrange(0, 12))]))
    return rows


def ref_pack(rows, block, remainder="reference"):
    """Concatenate per source in order, cut, apply the remainder rule."""
    out = {}
    for src in sorted({r[0] for r in rows}):
        toks = [t for r in sorted((r for r in rows if r[0] == src), key=lambda r: r[1]) for t in r[2]]
        blocks = [toks[i:i + block] for i in range(0, len(toks), block)]
        if remainder == "reference" and len(toks) >= block:
            blocks = [b for b in blocks if len(b) == block]
        if remainder == "drop":
            blocks = [b for b in blocks if len(b) == block]
        for k, b in enumerate(blocks):
            out[(src, k)] = b
    return out


def ref_pack_batch(rows, block, workers, batch_rows):
    out = {}
    for src in sorted({r[0] for r in rows}):
        lst = sorted((r for r in rows if r[0] == src), key=lambda r: r[1])
        n = len(lst)
        w = min(workers, n)
        q, m = divmod(n, w)
        shards, start = [], 0
        for s in range(w):
            size = q + 1 if s < m else q
            shards.append(lst[start:start + size])
            start += size
        k = 0
        for sh in shards:
            for b0 in range(0, len(sh), batch_rows):
                toks = [t for r in sh[b0:b0 + batch_rows] for t in r[2]]
                total = len(toks)
                if total >= block:
                    total = total // block * block
                for i in range(0, total, block):
                    out[(src, k)] = toks[i:i + block]
                    k += 1
    return out


def collect_blocks(df):
    return {(r.source, r.block_id): list(r.input_ids) for r in df.collect()}


def test_dense_index_buckets_and_skew(spark):
    rows = [("hot", i, i % 5) for i in range(500)] + [("cold", i * 7, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, k bigint, s int").repartition(7)
    out = dense_index(df, order=["k"], group=["g"], size="s", bucket_rows=16, offset_col="off",
                      group_rows_col="n").collect()
    for g in ("hot", "cold"):
        mine = sorted((r.k, r.idx, r.off, r.n) for r in out if r.g == g)
        run = 0
        for i, (k, idx, off, n) in enumerate(mine):
            assert (idx, off, n) == (i, run, len(mine))
            run += [x for x in rows if x[0] == g and x[1] == k][0][2]


@pytest.mark.parametrize("remainder", ["reference", "drop", "keep"])
def test_pack_global_matches_python(spark, remainder):
    rows = token_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = collect_blocks(pack(df, block=8, order=["idx"], remainder=remainder, bucket_rows=4))
    assert got == ref_pack(rows, 8, remainder)


def test_pack_pad_and_labels(spark):
    rows = token_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = pack(df, block=8, order=["idx"], remainder="pad", pad_id=0).collect()
    want = ref_pack(rows, 8, "keep")
    for r in out:
        real = want[(r.source, r.block_id)]
        assert len(r.input_ids) == 8 and list(r.input_ids[:len(real)]) == real
        assert list(r.attention_mask) == [1] * len(real) + [0] * (8 - len(real))
        assert list(r.labels) == real + [-100] * (8 - len(real))


def test_pack_batch_mode(spark):
    rows = token_rows(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = collect_blocks(pack(df, block=8, mode="batch", order=["idx"], workers=3, batch_rows=4, bucket_rows=5))
    assert got == ref_pack_batch(rows, 8, 3, 4)
    one = collect_blocks(pack(df, block=8, mode="batch", order=["idx"], workers=1, batch_rows=10_000))
    assert one == collect_blocks(pack(df, block=8, order=["idx"]))


def test_accounting_and_invariance(spark):
    rows = token_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = pack(df, block=8, order=["idx"])
    acc = {r.source: r for r in accounting(df, blocks).collect()}
    for src, r in acc.items():
        assert r.tokens_kept + r.tokens_dropped == r.tokens_in
    assert collect_blocks(pack(df.repartition(11), block=8, order=["idx"])) == collect_blocks(blocks)
    flat = [t for k in sorted(k for k in collect_blocks(blocks) if k[0] == "a") for t in collect_blocks(blocks)[k]]
    full = [t for r in sorted((r for r in rows if r[0] == "a"), key=lambda r: r[1]) for t in r[2]]
    assert full[:len(flat)] == flat


def test_block_size_rule():
    assert effective_block_size(None, 4096) == 1024
    assert effective_block_size(256, 128) == 128
    assert effective_block_size(256, None) == 256


def test_late_tokenisation_equals_early(spark):
    from quire.operators.tokenise import codepoint_size, tokenise_codepoint
    texts = [("s", i, "ཀ་ཁ་ " * (i % 9) + "x" * (i % 4)) for i in range(80)] + [("t", 0, "")]
    df = spark.createDataFrame(texts, "source string, doc_id bigint, text string")
    early = collect_blocks(pack(tokenise_codepoint(df), block=16))
    late = collect_blocks(pack(df, block=16, tokenise=tokenise_codepoint, size=codepoint_size("text")))
    assert early == late
    for mode_kw in ({"mode": "batch", "workers": 3, "batch_rows": 7},):
        assert collect_blocks(pack(tokenise_codepoint(df), block=16, **mode_kw)) == \
            collect_blocks(pack(df, block=16, tokenise=tokenise_codepoint, size=codepoint_size("text"), **mode_kw))
    wrong = pack(df, block=16, tokenise=tokenise_codepoint, size=codepoint_size("text", bos=None))
    with pytest.raises(Exception, match="token count differs"):
        wrong.collect()


def test_null_keys_are_kept(spark):
    rows = [(None, 1, [1, 2]), (None, None, [3]), ("a", None, [4, 5]), ("a", 2, [6])]
    df = spark.createDataFrame(rows, SCHEMA)
    idx = {(r.source, r.idx): r.i for r in dense_index(df, order=["idx"], group=["source"], idx_col="i").collect()}
    assert idx == {(None, None): 0, (None, 1): 1, ("a", None): 0, ("a", 2): 1}
    blocks = collect_blocks(pack(df, block=2, order=["idx"], remainder="keep"))
    assert blocks == {(None, 0): [3, 1], (None, 1): [2], ("a", 0): [4, 5], ("a", 1): [6]}


def test_null_source_batch_mode(spark):
    rows = [(None, 1, [1, 2, 3]), (None, 2, [4]), ("a", 1, [5, 6])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect_blocks(pack(df, block=2, mode="batch", order=["idx"], workers=2, batch_rows=5))
    want = ref_pack_batch([(r[0] or "", r[1], r[2]) for r in rows], 2, 2, 5)
    assert got == {(k[0] or None, k[1]): v for k, v in want.items()}
