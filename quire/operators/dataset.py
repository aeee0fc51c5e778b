"""Dataset operations (P5-P11, S14): concatenation, exact repeatable split,
row caps, weighted mixture, batch assembly, step accounting, shards.

Selection "the first k rows in a seeded shuffle order" is exact and never
sorts everything in one task: rows fall into 16^h buckets by the first h hex
digits of their md5 key; bucket totals (small) say which buckets lie wholly
before or after the cut; only the one boundary bucket per group is ranked.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.index import DEFAULT_BUCKET_ROWS, dense_index, keyed_index, md5_key
from quire.schemas import same_schema
from quire.session import stored

PREFIX_HEX = 4
MAX_BROADCAST_BUCKET_ROWS = 4_000_000


def select_prefix(df: DataFrame, key: str, ties: Sequence[str], target: int | DataFrame,
                  group: Sequence[str] = (), size: Column | None = None,
                  max_groups: int | None = 1, prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """Flag (``_sel``) the rows whose running size in (key, ties) order, within
    their group, stays <= target. ``target`` is a number, or a DataFrame of
    (group..., ``_target``). With ``size`` unset every row counts 1, so the
    first ``target`` rows are flagged. ``max_groups`` bounds the number of
    groups (None: unknown), which decides whether the bucket table is broadcast."""
    group = list(group)
    d = df.withColumn("_p", F.conv(F.substring(key, 1, prefix_hex), 16, 10).cast("long")) \
          .withColumn("_w", F.coalesce((size if size is not None else F.lit(1)).cast("long"), F.lit(0)))
    tot = d.groupBy(*group, "_p").agg(F.sum("_w").alias("_ps"), F.min("_w").alias("_pmin"))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("_pb", F.coalesce(F.sum("_ps").over(before), F.lit(0)))
    if isinstance(target, DataFrame):
        tot = tot.join(F.broadcast(target.select(*group, "_target")) if max_groups else
                       target.select(*group, "_target"), on=group, how="inner")
    else:
        tot = tot.withColumn("_target", F.lit(int(target)))
    status = (F.when(F.col("_pb") + F.col("_ps") <= F.col("_target"), F.lit("all"))
              .when(F.col("_pb") + F.col("_pmin") > F.col("_target"), F.lit("none"))
              .otherwise(F.lit("part")))
    st = tot.select(*group, "_p", "_pb", "_target", status.alias("_st"))
    if max_groups is not None and max_groups * 16 ** prefix_hex <= MAX_BROADCAST_BUCKET_ROWS:
        st = F.broadcast(st)
    j = d.join(st, on=[*group, "_p"], how="inner")
    whole = j.where(F.col("_st") != "part").withColumn("_sel", F.col("_st") == "all")
    w = Window.partitionBy(*group, "_p").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    part = j.where(F.col("_st") == "part") \
            .withColumn("_sel", F.col("_pb") + F.sum("_w").over(w) <= F.col("_target"))
    return whole.unionByName(part).drop("_p", "_w", "_pb", "_target", "_st")


def split_exact(df: DataFrame, frac: float, seed: int, ids: Sequence[str],
                n: int | None = None, materialize: bool = True) -> DataFrame:
    """Add ``split``: 'test' for the first ``ceil(frac * n)`` rows in the
    order md5('seed:ids'), then ids; 'train' for the rest (P6). ``frac`` is a
    fraction in (0, 1), as the reference's "percentage" really is.

    The selection reads its input three times (bucket totals, whole buckets,
    boundary bucket), so by default the input is first written once with a
    reliable ``checkpoint()`` into the session's checkpoint folder, which
    also cuts the lineage (the reference saves its processed data before the
    split as well)."""
    if not 0 < frac < 1:
        raise ValueError("frac must be in (0, 1)")
    if materialize:
        from quire.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    n = df.count() if n is None else n
    k = math.ceil(float(frac) * n)
    keyed = df.withColumn("_key", md5_key(seed, *ids))
    sel = select_prefix(keyed, "_key", list(ids), k)
    return sel.withColumn("split", F.when(F.col("_sel"), F.lit("test")).otherwise(F.lit("train"))) \
              .drop("_sel", "_key")


def cap(df: DataFrame, n: int, seed: int, ids: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in shuffle order (P7); all rows when fewer."""
    keyed = df.withColumn("_key", md5_key(seed, *ids))
    return select_prefix(keyed, "_key", list(ids), n).where("_sel").drop("_sel", "_key")


def mixture_targets(sizes: Mapping, weights: Mapping) -> dict:
    """Scale every group to its weight against the limiting group (exact
    rational arithmetic): target_g = floor(w_g * S_h / w_h)."""
    if any(w < 0 for w in weights.values()) or not any(w > 0 for w in weights.values()):
        raise ValueError("weights must be >= 0 with at least one positive")
    ratios = {g: Fraction(sizes.get(g, 0)) / Fraction(w) for g, w in weights.items() if w > 0}
    h = min(ratios, key=lambda g: (ratios[g], str(g)))
    return {g: math.floor(Fraction(w) * ratios[h]) if w > 0 else 0 for g, w in weights.items()}


def mix(df: DataFrame, group_col: str, weights: Mapping, seed: int, ids: Sequence[str],
        unit: str = "rows", size: Column | str | None = None) -> DataFrame:
    """Weighted mixture (P8): keep, per group, the longest prefix in shuffle
    order whose rows (``unit="rows"``) or sizes (``unit="tokens"``) stay within
    the group's target. Rows of groups without a weight are left out."""
    if unit not in ("rows", "tokens"):
        raise ValueError("unit must be 'rows' or 'tokens'")
    w = None if unit == "rows" else (F.col(size) if isinstance(size, str) else size)
    if unit == "tokens" and w is None:
        raise ValueError("unit='tokens' needs a size column")
    d = df.where(F.col(group_col).isin(list(weights)))
    totals = d.groupBy(group_col).agg((F.count(F.lit(1)) if w is None else F.sum(w)).alias("s")).collect()
    targets = mixture_targets({r[group_col]: int(r["s"] or 0) for r in totals}, weights)
    from quire.sources.tables import literal_rows
    tdf = literal_rows(df.sparkSession, [(g, int(t)) for g, t in targets.items()],
                       f"{group_col} {d.schema[group_col].dataType.simpleString()}, _target long")
    keyed = d.withColumn("_key", md5_key(seed, *ids))
    sel = select_prefix(keyed, "_key", list(ids), tdf, group=[group_col], size=w,
                        max_groups=len(weights))
    return sel.where("_sel").drop("_sel", "_key")


def concat_sources(parts: Sequence[tuple[str, DataFrame]], order: Sequence[str],
                   bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Append datasets in name order after a schema check (P5/O4). Adds
    ``part`` and a global dense ``row_idx`` over (part, order); a part named
    None comes first."""
    parts = sorted(parts, key=lambda p: (p[0] is not None, p[0]))
    first = parts[0][1].schema
    for name, d in parts[1:]:
        if not same_schema(first, d.schema):
            raise ValueError(f"schema of part {name!r} differs from {parts[0][0]!r}")
    out = None
    for name, d in parts:
        d = d.withColumn("part", F.lit(name).cast("string"))
        out = d if out is None else out.unionByName(d)
    order = list(order)
    return dense_index(out, order=["part", *order], group=(), idx_col="row_idx",
                       bucket=[F.col("part"), *[F.col(c) for c in order[:-1]],
                               F.floor(F.col(order[-1]) / bucket_rows)])


def batch(df: DataFrame, size: int, order: Sequence[str], ragged: str = "fail",
          cols: Sequence[str] = ("input_ids", "attention_mask", "labels"),
          bucket: Sequence[Column] | None = None, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Rows -> batches of ``size`` in ``order`` (P9). ``batch_id = idx div
    size``; a batch holds at most ``size`` rows. Unequal lengths inside a batch:
    in any column ``ragged="fail"`` raises, ``"first"`` repeats the batch's first row (P10)."""
    if ragged not in ("fail", "first"):
        raise ValueError("ragged must be 'fail' or 'first'")
    if size < 1:
        raise ValueError("batch size must be at least 1")
    cols, n_cols = list(cols), len(cols)
    # read three times below: written once, it is made once and its shuffles are gone
    df = stored(df.sparkSession, df.select(*dict.fromkeys([*order, *cols])), "rows")
    # lengths are taken before anything is moved, and every column is gathered by itself, so that columns nobody asks for stay behind
    sized = df.select(*order, *cols, *[F.size(c).alias(f"_n{i}") for i, c in enumerate(cols)])
    idx, keys = keyed_index(sized, order=list(order), bucket=bucket, bucket_rows=bucket_rows)
    # most batches lie within a bucket, whose rows are together; the few that do not are put together afterwards
    parts = idx.withColumn("batch_id", F.floor(F.col("idx") / size).cast("long")).groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(f"_n{i}").alias(f"_{f.__name__}{i}") for i in range(n_cols) for f in (F.min, F.max)],
        *[F.collect_list(F.struct("idx", F.col(c).alias("v"))).alias(f"_v{i}") for i, c in enumerate(cols)])
    whole = parts.where(F.col("_rows") == size).drop(*keys)
    cut = parts.where(F.col("_rows") < size).groupBy("batch_id").agg(
        F.sum("_rows").alias("_rows"),
        *[f(f"_{f.__name__}{i}").alias(f"_{f.__name__}{i}") for i in range(n_cols) for f in (F.min, F.max)],
        *[F.flatten(F.collect_list(f"_v{i}")).alias(f"_v{i}") for i in range(n_cols)])
    is_ragged = F.lit(False)
    for i in range(n_cols):
        is_ragged = is_ragged | (F.col(f"_min{i}") != F.col(f"_max{i}"))
    out = [F.col("batch_id"), F.col("_rows").cast("int").alias("rows"), is_ragged.alias("ragged")]
    for i, c in enumerate(cols):
        stacked = F.transform(F.array_sort(f"_v{i}"), _field("v"))
        if ragged == "first":
            stacked = F.when(is_ragged, F.array_repeat(stacked[0], F.col("_rows").cast("int"))).otherwise(stacked)
        else:
            stacked = F.when(is_ragged, F.raise_error(F.lit("ragged batch: rows of unequal length"))
                             ).otherwise(stacked)
        out.append(stacked.alias(c))
    return whole.unionByName(cut).select(*out)


def collate(df: DataFrame, size: int, order: Sequence[str], ragged: str = "fail",
            bucket: Sequence[Column] | None = None, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Rows -> batches by the schema (P9): of all columns but ``order`` those
    that are no strings are stacked, each into an array of its own type, where
    the batch's first row has a value; otherwise the batch has none (null).

    ``label`` (a number) or, where the first row has none, ``label_ids`` (an
    array) gives ``labels``: longs if whole numbers by type, else doubles. A
    column named ``labels`` that has values goes before them.

    Arrays must have equal lengths at every depth: ``ragged="fail"`` raises,
    ``"first"`` repeats the first row's values in all columns but those of the
    labels (P10). A null behind a first value raises, as does a ragged ``label_ids``."""
    if ragged not in ("fail", "first"):
        raise ValueError("ragged must be 'fail' or 'first'")
    if size < 1:
        raise ValueError("batch size must be at least 1")
    kinds = {f.name: f.dataType for f in df.schema if f.name not in order}
    keys = [c for c, t in kinds.items() if c not in ("label", "label_ids") and not isinstance(t, (T.StringType, T.VarcharType, T.CharType))]
    used = [*keys, *[c for c in ("label", "label_ids") if c in kinds]]
    idx = dense_index(df.select(*order, *used), order=list(order), bucket=bucket, bucket_rows=bucket_rows)
    g = (idx.withColumn("batch_id", F.floor(F.col("idx") / size).cast("long")).groupBy("batch_id")
            .agg(F.array_sort(F.collect_list(F.struct("idx", F.struct(*used).alias("v")))).alias("_r"))
            .select("batch_id", F.transform("_r", lambda x: x["v"]).alias("_r")))

    def first(c: str) -> Column:
        return F.col("_r")[0][c]

    def stacked(c: str) -> Column:
        values = F.transform("_r", _field(c))
        empty = F.raise_error(F.lit(f"null in column {c} behind a first value"))
        return F.when(F.exists(values, lambda x: x.isNull()), empty.cast(T.ArrayType(kinds[c]))).otherwise(values)

    def uneven(c: str) -> Column:
        kind, values, out = kinds[c], F.filter(F.transform("_r", _field(c)), lambda x: x.isNotNull()), F.lit(False)
        while isinstance(kind, T.ArrayType):
            lens = F.transform(values, lambda x: F.size(x))
            out = out | (F.array_min(lens) != F.array_max(lens))
            kind, values = kind.elementType, F.flatten(values)
        return F.coalesce(out, F.lit(False))

    is_ragged = F.lit(False)
    for c in keys:
        is_ragged = is_ragged | (first(c).isNotNull() & uneven(c))
    out = {}
    for c in keys:
        if ragged == "first":
            value = F.when(F.col("ragged"), F.array_repeat(first(c), F.size("_r"))).otherwise(stacked(c))
        else:
            stop = F.raise_error(F.lit("ragged batch: rows of unequal length")).cast(T.ArrayType(kinds[c]))
            value = F.when(F.col("ragged"), stop).otherwise(stacked(c))
        out[c] = F.when(first(c).isNotNull(), value)
    labels = [out.pop("labels")] if "labels" in out else []
    if "label" in kinds:
        labels.append(F.when(first("label").isNotNull(), stacked("label")).cast(T.ArrayType(_label_type(kinds["label"]))))
    if "label_ids" in kinds:
        stop = F.raise_error(F.lit("label_ids of unequal length")).cast(T.ArrayType(kinds["label_ids"]))
        ids = F.when(uneven("label_ids"), stop).otherwise(stacked("label_ids"))
        labels.append(F.when(first("label_ids").isNotNull(), ids).cast(T.ArrayType(_label_type(kinds["label_ids"]))))
    made = g.withColumn("ragged", is_ragged)
    if labels:
        shapes = {made.select(c.alias("c")).schema["c"].dataType.simpleString() for c in labels}
        if len(shapes) > 1:
            made = _one_label_column(made, labels, shapes)
        else:
            made = made.withColumn("_labels", F.coalesce(*labels))
        out["labels"] = F.col("_labels")
    return made.select("batch_id", F.size("_r").cast("int").alias("rows"), "ragged", *[v.alias(c) for c, v in out.items()])


def _one_label_column(made: DataFrame, labels: list[Column], shapes: set[str]) -> DataFrame:
    """Labels that come as numbers in one batch and as arrays in another cannot
    share a column; only one of the sources may have values then."""
    first, *rest = labels
    both = F.raise_error(F.lit(f"labels of different shapes: {sorted(shapes)}"))
    clash = F.lit(False)
    for other in rest:
        clash = clash | (first.isNull() & other.isNotNull())
    kind = made.select(first.alias("c")).schema["c"].dataType
    return made.withColumn("_labels", F.when(clash, both.cast(kind)).otherwise(first))


def _label_type(kind: T.DataType) -> T.DataType:
    """Longs for whole numbers, doubles for others, inside arrays as well."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_label_type(kind.elementType))
    return T.LongType() if isinstance(kind, (T.IntegralType, T.BooleanType)) else T.DoubleType()


def _field(name: str):
    return lambda x: x[name]


def step_report(blocks: DataFrame, batch_size: int, accumulation: int, block: int) -> DataFrame:
    """Rows and tokens per optimiser step and the number of steps."""
    per_step = batch_size * accumulation
    n = F.count(F.lit(1))
    return blocks.agg(
        n.alias("n_blocks"),
        F.lit(per_step).cast("long").alias("rows_per_step"),
        F.lit(per_step * block).cast("long").alias("tokens_per_step"),
        F.ceil(n / F.lit(per_step)).cast("long").alias("steps"),
        (n * F.lit(block)).cast("long").alias("tokens"),
    )


def sample_counts(df: DataFrame, phase: str, max_samples: int | None) -> DataFrame:
    """``min(max_samples or n, n)``."""
    n = F.count(F.lit(1))
    v = n if max_samples is None else F.least(F.lit(max_samples).cast("long"), n)
    return df.agg(F.lit(phase).alias("phase"), v.cast("long").alias("samples"))


def export_shards(df: DataFrame, n: int, order: Sequence[str], bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Shard number for an export in ``n`` equal parts in ``order``; the
    remainder goes to the last shard (S14): ``least(idx div (N div n), n-1)``."""
    if n < 1:
        raise ValueError("the number of shards must be at least 1")
    idx = dense_index(df, order=list(order), bucket_rows=bucket_rows, group_rows_col="_n")
    per = F.floor(F.col("_n") / n)
    shard = F.when(per == 0, F.lit(n - 1)).otherwise(F.least(F.floor(F.col("idx") / per), F.lit(n - 1)))
    return idx.withColumn("shard", shard.cast("int")).drop("_n")
