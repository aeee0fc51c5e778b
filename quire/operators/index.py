"""Row numbers and running sums in an explicit order, without a global window.

A running sum over a whole corpus in one ``Window.orderBy`` puts every row in
one task. Instead rows are cut into order-compatible buckets (``bucket_rows``
consecutive keys each):

1. one row per bucket with its row count and size sum (partial aggregation,
   small shuffle);
2. a running sum over that small bucket table gives each bucket's base: within
   a group by a window over the group's buckets, without groups by a tree of
   totals (ranges of buckets, ranges of at most ``FANOUT`` ranges, ...), so
   that no window is without a partition key;
3. a window partitioned by (group, bucket) finishes the sum inside the bucket.

The join in (3) and the window share the (group, bucket) hash partitioning,
so the payload is shuffled once, and no task holds more than one bucket of
rows even when one group (source) holds a third of the data. The input is
evaluated twice (totals and payload); materialise an expensive input first
(``checkpoint`` or the processed-data cache) to compute it once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ensure_checkpoint_dir, frees_shuffles, scratch_path, ship_package

DEFAULT_BUCKET_ROWS = 4096
FANOUT = 10_000


def default_bucket(order: Sequence[str], bucket_rows: int) -> list[Column]:
    """Buckets for an order whose last column is an integer key: the leading
    order columns as they are, the last one divided by ``bucket_rows``."""
    *lead, last = order
    return [F.col(c) for c in lead] + [F.floor(F.col(last) / F.lit(bucket_rows))]


def dense_index(df: DataFrame, order: Sequence[str], group: Sequence[str] = (),
                size: Column | str | None = None, bucket: Sequence[Column] | None = None,
                bucket_rows: int = DEFAULT_BUCKET_ROWS, idx_col: str = "idx",
                offset_col: str | None = None, group_rows_col: str | None = None,
                group_size_col: str | None = None, fanout: int = FANOUT) -> DataFrame:
    """Add a 0-based dense row index (``idx_col``) in ``order`` within each
    ``group``; with ``size``, also the running sum of sizes before the row
    (``offset_col``). Optional per-group totals of rows / sizes.

    ``order`` must be a total order within a group; ``bucket`` must be
    non-decreasing along it (default: see :func:`default_bucket`). Without a
    group the bucket totals are written once (``checkpoint``) and summed up a
    tree with ``fanout`` children a node."""
    j, keys = keyed_index(df, order, group, size, bucket, bucket_rows, idx_col, offset_col, group_rows_col, group_size_col, fanout)
    return j.drop(*keys)


def keyed_index(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), size: Column | str | None = None,
                bucket: Sequence[Column] | None = None, bucket_rows: int = DEFAULT_BUCKET_ROWS, idx_col: str = "idx",
                offset_col: str | None = None, group_rows_col: str | None = None, group_size_col: str | None = None,
                fanout: int = FANOUT) -> tuple[DataFrame, list[str]]:
    """:func:`dense_index` with the columns, named second, by which its rows lie
    together: a step that groups by these needs no shuffle."""
    group = list(group)
    order = list(order)
    bucket = list(bucket) if bucket is not None else default_bucket(order, bucket_rows)
    bcols = [f"_qb{i}" for i in range(len(bucket))]
    sz = (F.col(size) if isinstance(size, str) else size) if size is not None else F.lit(1)
    d = df.select("*", *[b.alias(n) for b, n in zip(bucket, bcols)], sz.cast("long").alias("_qsz"))

    # Each key becomes two non-null columns (is-null flag, value or default):
    # the join and the window then use plain equality on the same columns
    # (one shuffle, no inferred null filters) and a NULL key keeps its rows.
    enc_g, enc_b, enc_cols = [], [], []
    for n, k in enumerate(group + bcols):
        flag, val = f"_qn{n}", f"_qv{n}"
        enc_cols += [F.isnull(k).alias(flag), F.coalesce(F.col(k), _default(d.schema[k].dataType)).alias(val)]
        (enc_g if n < len(group) else enc_b).append((flag, val))
    d = d.select("*", *enc_cols)
    g_keys = [c for fv in enc_g for c in fv]
    keys = g_keys + [c for fv in enc_b for c in fv]
    b_order = [x for flag, val in enc_b for x in (F.col(flag).desc(), F.col(val).asc())]

    # bucket totals: partially aggregated before the shuffle (one small row
    # per bucket and task); only the payload join below moves whole rows.
    totals = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_qn"), F.sum("_qsz").alias("_qs"))
    wanted = [(c, of) for c, of in ((group_rows_col, "_qn"), (group_size_col, "_qs")) if c]
    if g_keys:
        before = Window.partitionBy(*g_keys).orderBy(*b_order).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*g_keys)
        totals = totals.select(*keys, F.coalesce(F.sum("_qn").over(before), F.lit(0)).alias("_qrb"),
                               F.coalesce(F.sum("_qs").over(before), F.lit(0)).alias("_qsb"),
                               *[F.sum(of).over(whole).alias(c) for c, of in wanted])
    else:
        totals = tree_bases(totals, b_order, fanout).select(
            *keys, "_qrb", "_qsb", *[F.col(f"_all{of}").alias(c) for c, of in wanted])
    j = d.join(totals, on=keys, how="inner")
    inner = Window.partitionBy(*keys).orderBy(*order)
    j = j.withColumn(idx_col, F.col("_qrb") + F.row_number().over(inner) - 1)
    if offset_col:
        running = F.sum("_qsz").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        j = j.withColumn(offset_col, F.col("_qsb") + running - F.col("_qsz"))
    return j.drop(*bcols, "_qsz", "_qrb", "_qsb"), keys


def tree_bases(totals: DataFrame, order: list[Column], fanout: int = FANOUT) -> DataFrame:
    """``totals`` (with ``_qn`` and ``_qs``) with ``_qrb`` and ``_qsb``, the sums
    of all rows before in ``order``, and ``_all_qn`` and ``_all_qs``, those of all
    rows. The rows are dealt by range to the shuffle's partitions; ``fanout``
    parts make a node of the next level, until one is left."""
    spark = totals.sparkSession
    ensure_checkpoint_dir(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = _written(spark, totals.repartitionByRange(parts, *order).withColumn("_up", F.spark_partition_id().cast("long")))
    rows, sizes = dealt.agg(F.sum("_qn"), F.sum("_qs")).first()
    return _sum_up(dealt, order, parts, fanout).withColumns(
        {"_all_qn": F.lit(rows or 0).cast("long"), "_all_qs": F.lit(sizes or 0).cast("long")})


@frees_shuffles
def _written(spark: SparkSession, totals: DataFrame) -> DataFrame:
    """The totals as a table; the shuffles that led to them are not needed any more."""
    return totals.select("*").checkpoint()


def _sum_up(nodes: DataFrame, order: list[Column], parents: int, fanout: int, level: int = 0) -> DataFrame:
    before = Window.partitionBy("_up").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = nodes.withColumn("_qrb", F.coalesce(F.sum("_qn").over(before), F.lit(0))) \
                .withColumn("_qsb", F.coalesce(F.sum("_qs").over(before), F.lit(0)))
    if parents == 1:
        return here.drop("_up")
    at = f"_at{level}"
    above = nodes.groupBy(F.col("_up").alias(at)).agg(F.sum("_qn").alias("_qn"), F.sum("_qs").alias("_qs")) \
                 .withColumn("_up", F.expr(f"{at} div {fanout}"))
    above = _sum_up(above, [F.col(at)], -(-parents // fanout), fanout, level + 1).select(
        at, F.col("_qrb").alias("_rows"), F.col("_qsb").alias("_sizes"))
    return here.join(above, F.col("_up") == F.col(at)).withColumn("_qrb", F.col("_qrb") + F.col("_rows")) \
               .withColumn("_qsb", F.col("_qsb") + F.col("_sizes")).drop("_up", at, "_rows", "_sizes")


def range_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], idx_col: str = "idx") -> DataFrame:
    """``df`` with its 0-based row number within ``group`` by ``order``, both
    ascending, nulls first. Rows that are equal in all of these are numbered in
    any order. The result is read from a table in the scratch folder.

    Rows are dealt by ranges of (group, order, a row's own number), so that
    neither a group nor a repeated key is bound to one task, and are counted as
    they stream by in order. A group that goes over several ranges is the first
    or last of each; only these, at most two rows a range, are summed over the
    ranges and broadcast. ``df`` should be a scan or a narrow step over one: a
    row's own number must come out alike if a task is run again."""
    spark = df.sparkSession
    ship_package(spark)
    keys = [*group, *order, "_own"]
    dealt = (df.withColumn("_own", F.monotonically_increasing_id())
             .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_own").withColumn("_part", F.spark_partition_id()))
    schema = T.StructType([*dealt.schema.fields, T.StructField("_run", T.LongType()), T.StructField("_nth", T.LongType())])
    names = list(group)
    path = scratch_path(spark, "ranked")
    dealt.mapInArrow(lambda batches: _number_runs(batches, names), schema).write.parquet(path)
    rows = spark.read.parquet(path)
    last = rows.groupBy("_part").agg(F.max("_run").alias("_last"))  # a row a range
    ends = (rows.select("_part", "_run", *group).join(F.broadcast(last), "_part").where("_run = 0 or _run = _last")
            .groupBy("_part", "_run", *group).agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if not group:
        before = Window.partitionBy("_run").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one run a range
    bases = ends.select("_part", "_run", F.sum("_n").over(before).alias("_base"))
    return (rows.join(F.broadcast(bases), ["_part", "_run"], "left")
            .withColumn(idx_col, F.coalesce("_base", F.lit(0)) + F.col("_nth")).drop("_part", "_run", "_nth", "_base"))


def _number_runs(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted partition with the number of their run of equal
    ``group`` and their place in it."""
    last, run, upto = None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for name in group:
            col = batch.column(name)
            before = pa.concat_arrays([last.column(name) if last is not None else col.slice(0, 1), col.slice(0, n - 1)])
            differs = pc.fill_null(pc.not_equal(col, before), False).to_numpy(zero_copy_only=False)
            new |= differs | (np.asarray(col.is_null()) != np.asarray(before.is_null()))
        at = np.arange(n)
        runs = run + np.cumsum(new)
        start = np.maximum.accumulate(np.where(new, at, -1))
        nth = np.where(start < 0, upto + at, at - start)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs), pa.array(nth)], [*batch.schema.names, "_run", "_nth"])
        last, run, upto = batch.slice(n - 1, 1), int(runs[-1]), int(nth[-1]) + 1


def _default(dt: T.DataType) -> Column:
    """A non-null stand-in value of the key's type (paired with its is-null flag)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    return F.lit(0).cast(dt) if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
        else F.lit("").cast(dt)


def md5_key(seed: int | str, *cols: Column | str) -> Column:
    """Repeatable shuffle key: ``md5('<seed>:<c1>:<c2>...')``. The same string
    is easy to build in any SQL engine, so an oracle can repeat the order."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))
