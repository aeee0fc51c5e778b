"""Keyed merges on tables (J1-J4, O1, O2): the weight-merge operations of the
reference re-aimed at keyed vector tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ship_package


def _one_per_key(patch: DataFrame, key: list[str], columns: list) -> DataFrame:
    """``columns`` of the patch as ``_p``, one row per key; a repeated key is an
    error, as which row wins is for the caller to say (:func:`last_wins`)."""
    many = F.raise_error(F.lit("patch key repeats: apply last_wins first"))
    row = F.struct(*columns)
    one = patch.groupBy(*key).agg(F.any_value(row).alias("_p"), F.count(F.lit(1)).alias("_n"))
    return one.select(*key, F.when(F.col("_n") > 1, many.cast(one.schema["_p"].dataType)).otherwise(F.col("_p")).alias("_p"))


def override(base: DataFrame, patch: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Where ``patch`` has the key, its values replace the base values.
    Patch keys absent from base are ignored; a patch key must not repeat."""
    key = list(key)
    p = _one_per_key(patch, key, [F.col(c).alias(f"_p_{c}") for c in cols]).select(*key, "_p.*")
    j = base.join(p, on=key, how="left")
    out = [F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns]
    return j.select(*out)


def override_fields(base: DataFrame, patch: DataFrame, key: Sequence[str],
                    fields: Mapping[str, Column]) -> DataFrame:
    """Take the whole record from ``patch`` where present; otherwise the base
    record with ``fields`` replaced by the given expressions (J2)."""
    key = list(key)
    others = [c for c in base.columns if c not in key]
    p = _one_per_key(patch, key, [F.lit(True).alias("_hit"), *[F.col(c).alias(f"_p_{c}") for c in others]]).select(*key, "_p.*")
    j = base.join(p, on=key, how="left")
    out = []
    for c in base.columns:
        if c in key:
            out.append(F.col(c))
            continue
        fallback = fields.get(c, F.col(c))
        out.append(F.when(F.col("_hit"), F.col(f"_p_{c}")).otherwise(fallback).alias(c))
    return j.select(*out)


def last_wins(parts: DataFrame, key: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Union of parts where the part latest in ``order`` wins per key (J3,
    O1, O5). ``order`` compares as text, so 'L10-' comes before 'L2-'. An
    aggregate with map-side combine: a hot key costs no more than any other."""
    best = F.max_by(F.struct(F.col(order).alias(order), *[F.col(v) for v in values]), F.col(order))
    return parts.groupBy(*key).agg(best.alias("_w")).select(*key, "_w.*")


def name_filter(col: Column | str, pattern: str) -> Column:
    """Regular-expression match from the start of the name (O2), like
    Python's ``re.match``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(f"^(?:{pattern})")


def apply_low_rank(df: DataFrame, a: np.ndarray, b: np.ndarray, alpha: float, r: int,
                   col: str = "embedding", out_col: str | None = None,
                   transpose: bool = False) -> DataFrame:
    """Low-rank update of every vector (J4): ``e + (alpha / r) * B (A e)``
    with A (r x d) and B (d x r); ``transpose`` uses ``(B A)^T`` instead.
    The matrices are bounded (r x d) and shipped once; vectors are updated a
    whole Arrow batch at a time with one matrix product."""
    a = np.asarray(a, dtype=np.float64)
    b = np.asarray(b, dtype=np.float64)
    if a.shape[0] != b.shape[1] or a.shape[1] != b.shape[0]:
        raise ValueError(f"shapes do not fit: A {a.shape}, B {b.shape}")
    scale = float(alpha) / float(r)
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast((a, b, scale, transpose))
    out_col = out_col or col

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def update(vectors):
        import pandas as pd
        am, bm, s, tr = bc.value
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        e = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        delta = (e @ bm) @ am if tr else (e @ am.T) @ bm.T
        res = e + s * delta
        return pd.Series(list(res))

    return df.withColumn(out_col, update(F.col(col)))


def class_means(df: DataFrame, labels: Sequence[int], col: str = "embedding",
                label_col: str = "label") -> np.ndarray:
    """Element-wise mean vector per label, as an (len(labels) x d) matrix.
    Aggregated on the executors; only the small matrix reaches the driver."""
    x = (df.where(F.col(label_col).isin(list(labels)))
           .select(label_col, F.posexplode(col).alias("pos", "v"))
           .groupBy(label_col, "pos").agg(F.avg("v").alias("m")))
    rows = x.collect()
    d = max(r["pos"] for r in rows) + 1
    out = np.zeros((len(labels), d))
    where = {lab: i for i, lab in enumerate(labels)}
    for r in rows:
        out[where[r[label_col]], r["pos"]] = r["m"]
    return out
