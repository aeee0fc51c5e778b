"""Split, cap, mixture, batches, shards."""
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from quire.operators import dataset as ds


def md5_order(seed, ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_split_exact_properties(spark):
    n = 2000
    df = spark.createDataFrame([(i,) for i in range(n)], "id bigint")
    for frac in (0.005, 0.07, 0.5):
        s = ds.split_exact(df.repartition(7), frac, 42, ["id"], materialize=False)
        rows = s.collect()
        test = {r.id for r in rows if r.split == "test"}
        train = {r.id for r in rows if r.split == "train"}
        assert not test & train and len(test | train) == n
        assert len(test) == math.ceil(frac * n)
        assert test == set(md5_order(42, range(n))[:len(test)])
    again = ds.split_exact(df.repartition(3), 0.07, 42, ["id"])
    assert {r.id for r in again.where("split='test'").collect()} == set(md5_order(42, range(n))[:140])
    with pytest.raises(ValueError):
        ds.split_exact(df, 5, 42, ["id"])


def test_cap(spark):
    df = spark.createDataFrame([(i,) for i in range(300)], "id bigint")
    assert {r.id for r in ds.cap(df, 25, 7, ["id"]).collect()} == set(md5_order(7, range(300))[:25])
    assert ds.cap(df, 1000, 7, ["id"]).count() == 300


def test_mixture(spark):
    rows = [(i, "x" if i % 3 else "y", 1 + i % 5) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, g string, n int")
    sizes = {"x": sum(1 for r in rows if r[1] == "x"), "y": sum(1 for r in rows if r[1] == "y")}
    targets = ds.mixture_targets(sizes, {"x": 3, "y": 4})
    got = ds.mix(df, "g", {"x": 3, "y": 4}, 11, ["id"]).collect()
    counts = {g: sum(1 for r in got if r.g == g) for g in "xy"}
    assert counts == targets and counts["y"] == sizes["y"]             # the limiting group is complete
    tok = ds.mix(df, "g", {"x": 3, "y": 4}, 11, ["id"], unit="tokens", size="n").collect()
    tsz = {g: sum(r[2] for r in rows if r[1] == g) for g in "xy"}
    tt = ds.mixture_targets(tsz, {"x": 3, "y": 4})
    for g in "xy":
        ids = [i for i in md5_order(11, [r[0] for r in rows if r[1] == g])]
        run, want = 0, set()
        for i in ids:
            run += rows[i][2]
            if run <= tt[g]:
                want.add(i)
        assert {r.id for r in tok if r.g == g} == want


def test_batches(spark):
    rows = [(i, [i] * 4) for i in range(26)] + [(26, [1, 2])]     # 27 rows, last one short
    df = spark.createDataFrame(rows, "idx bigint, input_ids array<int>")
    df = df.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))) \
           .withColumn("labels", F.col("input_ids"))
    out = {r.batch_id: r for r in ds.batch(df, 12, ["idx"], ragged="first").collect()}
    assert [out[b].rows for b in sorted(out)] == [12, 12, 3]
    assert [list(x) for x in out[0].input_ids] == [[i] * 4 for i in range(12)]
    assert out[2].ragged and [list(x) for x in out[2].input_ids] == [[24] * 4] * 3
    with pytest.raises(Exception, match="ragged"):
        ds.batch(df, 12, ["idx"]).collect()


def test_shards_and_steps(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "k bigint")
    sh = {r.k: r.shard for r in ds.export_shards(df, 3, ["k"]).collect()}
    assert [sh[k] for k in range(11)] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2, 2]
    small = spark.createDataFrame([(i,) for i in range(2)], "k bigint")
    assert {r.shard for r in ds.export_shards(small, 3, ["k"]).collect()} == {2}
    rep = ds.step_report(df, 12, 8, 256).first()
    assert (rep.steps, rep.tokens, rep.tokens_per_step) == (1, 11 * 256, 24576)


def test_concat_schema_check(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("s",)], "x string")
    with pytest.raises(ValueError):
        ds.concat_sources([("a", a), ("b", b)], ["x"])
    c = ds.concat_sources([("b", a), ("a", a.union(a))], ["x"]).orderBy("row_idx").collect()
    assert [(r.part, r.row_idx) for r in c] == [("a", 0), ("a", 1), ("b", 2)]


def test_argument_checks_and_null_sizes(spark):
    from quire.operators.pack import pack
    df = spark.createDataFrame([(1, "x", None), (2, "x", 3), (3, "y", 1)], "id bigint, g string, n int")
    with pytest.raises(ValueError):
        ds.mixture_targets({"x": 1}, {"x": 0})
    with pytest.raises(ValueError):
        ds.export_shards(df, 0, ["id"])
    with pytest.raises(ValueError):
        ds.batch(df, 0, ["id"], cols=["n"])
    with pytest.raises(ValueError):
        pack(df.selectExpr("g AS source", "id AS doc_id", "array(1) AS input_ids"), block=0)
    alone = spark.createDataFrame([(1, "x", None), (2, "y", 3)], "id bigint, g string, n int")
    got = {r.id for r in ds.mix(alone, "g", {"x": 1, "y": 1}, 5, ["id"], unit="tokens", size="n").collect()}
    assert got == {1}                                 # a NULL size counts as 0: within a target of 0


def collator(rows, ragged):
    """What the collator makes of one batch of dicts, by its rules."""
    first, out = rows[0], {}
    for k in ("label", "label_ids"):
        if "labels" not in out and first.get(k) is not None:
            out["labels"] = [r[k] for r in rows]
    keys = [k for k, v in first.items() if k not in ("label", "label_ids") and v is not None and not isinstance(v, str)]
    uneven = any(isinstance(first[k], list) and len({len(r[k]) for r in rows}) > 1 for k in keys)
    for k in keys:
        out[k] = [first[k]] * len(rows) if uneven and ragged == "first" else [r[k] for r in rows]
    return out, uneven


def test_collate_by_schema(spark):
    rows = [{"i": i, "text": "s", "label": i % 2 if i < 8 else None, "label_ids": [float(i), 1.0], "x": i * 0.5,
             "ids": [i] * (2 if i < 4 else 1 + i % 2), "sometimes": i if i >= 4 else None, "deep": [[i, 1], [2, 3]]} for i in range(10)]
    schema = "i long, text string, label int, label_ids array<double>, x double, ids array<int>, sometimes long, deep array<array<long>>"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(3)
    numbers = ds.collate(df.drop("label_ids").where("i < 8"), 4, ["i"], ragged="first")
    for b in numbers.collect():
        some = [{k: v for k, v in r.items() if k not in ("i", "label_ids")} for r in rows[b.batch_id * 4:b.batch_id * 4 + 4]]
        want, uneven = collator(some, "first")
        assert b.ragged == uneven and b.rows == 4 and "text" not in b
        assert {k: b[k] for k in ("labels", "x", "ids", "sometimes", "deep") if b[k] is not None} == want
    assert dict(numbers.dtypes)["labels"] == "array<bigint>"
    arrays = ds.collate(df.drop("label").where("i >= 8"), 4, ["i"], ragged="first").first()
    assert arrays.labels == [[8.0, 1.0], [9.0, 1.0]] and dict(ds.collate(df.drop("label"), 4, ["i"]).dtypes)["labels"] == "array<array<double>>"
    for bad in (ds.collate(df.where("i >= 4"), 4, ["i"]), ds.collate(df.drop("label_ids"), 10, ["i"], ragged="first"),
                ds.collate(df, 4, ["i"], ragged="first")):
        with pytest.raises(Exception, match="ragged batch|null in column|different shapes"):
            bad.collect()
    own = ds.collate(spark.createDataFrame([(1, 2, 7), (2, 3, None)], "i long, label int, labels long"), 1, ["i"]).orderBy("batch_id")
    assert [r.labels for r in own.collect()] == [[7], [3]]
    assert not ds.collate(df.limit(0), 4, ["i"]).collect()


@pytest.mark.parametrize("size, bucket_rows, n", [(3, 5, 41), (4, 2, 9), (12, 4096, 30), (5, 5, 0), (7, 3, 7)])
def test_batches_over_buckets_are_those_of_the_order(spark, size, bucket_rows, n):
    """Batches within a bucket, over two and over many of them, nulls and unequal lengths."""
    rows = [(f"s{i % 2}" if i % 5 else None, i, None if i % 11 == 4 else [i] * (1 + (i % 9 == 7)), [i, i]) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, i long, input_ids array<long>, labels array<long>").repartition(4)
    got = {r.batch_id: r for r in ds.batch(df, size, ["source", "i"], ragged="first", cols=("input_ids", "labels"), bucket_rows=bucket_rows).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted(got) == list(range(-(-n // size)))
    for b, r in got.items():
        some = rows[b * size:(b + 1) * size]
        lens = {len(x[2]) for x in some if x[2] is not None}
        ragged = len(lens) > 1
        assert r.rows == len(some) and bool(r.ragged) == ragged
        assert r.input_ids == ([some[0][2]] * len(some) if ragged else [x[2] for x in some])
        assert r.labels == ([some[0][3]] * len(some) if ragged else [x[3] for x in some])


def test_batch_moves_rows_once_and_only_what_is_asked_for(spark):
    rows = [("s", i, [i] * 3, [i] * 3) for i in range(60)]
    df = spark.createDataFrame(rows, "source string, i long, input_ids array<long>, labels array<long>")
    out = ds.batch(df, 7, ["source", "i"], cols=("input_ids", "labels"), bucket_rows=10).select("batch_id", "input_ids")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    gathered = [x for x in plan.splitlines() if "collect_list" in x]
    assert gathered and not any("labels" in x for x in gathered)
    assert sorted(i for r in out.collect() for (i, *_) in r.input_ids) == list(range(60))
