"""Vocabulary operations (T6-T8): extension, size check, length comparison.
Vocabularies are bounded tables (id, piece, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def extend_vocab(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append the pieces of ``new`` that ``base`` lacks; old ids stay, added
    pieces get ``base size + rank`` in ``new``'s id order (first of
    duplicates wins)."""
    size = base.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("_size"))
    first = new.groupBy("piece").agg(F.min("id").alias("_nid"), F.max("score").alias("score"))
    added = first.join(base.select("piece"), on="piece", how="left_anti")
    ranked = added.crossJoin(F.broadcast(size)).select(
        (F.col("_size") + F.row_number().over(Window.orderBy("_nid")) - 1).cast("int").alias("id"),
        "piece", "score")
    return base.select("id", "piece", "score").unionByName(ranked)


def check_vocab(vocab: DataFrame, expected: int) -> DataFrame:
    """One-row report: entries, distinct ids and pieces, max id + 1 against
    the expected size; ``ok`` only when all agree."""
    r = vocab.agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.count_distinct("id").alias("n_ids"),
        F.count_distinct("piece").alias("n_pieces"),
        (F.max("id") + 1).cast("long").alias("id_span"),
    ).withColumn("expected", F.lit(int(expected)).cast("long"))
    ok = ((F.col("n_entries") == F.col("expected")) & (F.col("n_ids") == F.col("expected"))
          & (F.col("n_pieces") == F.col("expected")) & (F.col("id_span") == F.col("expected")))
    return r.withColumn("ok", ok)


def compare_lengths(a: DataFrame, b: DataFrame, key: str, by: str,
                    ids_col: str = "input_ids") -> DataFrame:
    """``1 - sum(len b) / sum(len a)`` per ``by`` value, with a total row
    (``by`` NULL) from ``rollup``; a and b are the same rows under two
    tokenizers, matched on ``key``."""
    j = (a.select(key, by, F.size(ids_col).alias("_na"))
          .join(b.select(key, F.size(ids_col).alias("_nb")), on=key))
    return j.rollup(by).agg(
        F.sum("_na").cast("long").alias("tokens_a"),
        F.sum("_nb").cast("long").alias("tokens_b"),
    ).withColumn("reduction", F.round(1 - F.try_divide(F.col("tokens_b"), F.col("tokens_a")), 6))
