"""Array functions on Columns: special-token removal, argmax, shifted pairs,
first-value typing. Built-in higher-order functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def drop_special(ids: Column | str, special: Sequence[int]) -> Column:
    """Remove every special id, keeping duplicates and order of the rest
    (``array_except`` would also remove duplicates)."""
    sp = F.array(*[F.lit(int(s)) for s in special])
    return F.filter(_c(ids), lambda x: ~F.array_contains(sp, x))


def argmax(values: Column | str) -> Column:
    """0-based index of the largest value, first of ties. Spark orders NaN
    above every number, so a NaN wins; an empty array gives NULL."""
    a = _c(values)
    return F.when(F.size(a) > 0, (F.array_position(a, F.array_max(a)) - 1).cast("int"))


def ones_like(ids: Column | str) -> Column:
    return F.array_repeat(F.lit(1), F.size(_c(ids)))


def shifted_pairs(preds: Column | str, labels: Column | str) -> Column:
    """Pairs (pred at t, label at t+1): ``preds[:-1]`` with ``labels[1:]``."""
    p, l = _c(preds), _c(labels)
    n = F.size(l) - 1
    return F.when(n > 0, F.arrays_zip(F.slice(p, 1, n).alias("pred"),
                                      F.slice(l, 2, n).alias("label"))
                  ).otherwise(F.array().cast("array<struct<pred:int,label:int>>"))


def label_typing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Target type per numeric column: ``bigint`` when every value is whole,
    else ``double`` (the collator's first-value rule made data-wide)."""
    parts = []
    for c in cols:
        v = F.col(c).cast("double")
        parts.append(df.agg(
            F.lit(c).alias("column"),
            F.count(v).alias("n"),
            F.count_if(v != F.floor(v)).alias("n_fractional"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "target_type", F.when(F.col("n_fractional") == 0, F.lit("bigint")).otherwise(F.lit("double")))
