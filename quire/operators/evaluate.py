"""Evaluation.

The smoothed bigram model (E5) gives accuracy and perplexity real inputs
without a neural model. Everything is computed on pre-aggregated pairs: test
pairs are counted per (prev, next) before any join, so the shuffles carry one
row per distinct pair, not one per token, and a very frequent token is
combined map-side like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import shifted_pairs

SMOOTHING = 1.0
MAX_BROADCAST_MODEL = 5_000_000


def token_accuracy(df: DataFrame, preds: str = "preds", labels: str = "labels",
                   by: Sequence[str] = (), mask: str | None = None) -> DataFrame:
    """E1 on array columns: pair prediction t with label t+1, share equal.
    Every position counts unless ``mask`` (array of 0/1 aligned with labels)
    is given (Q12)."""
    pairs = shifted_pairs(preds, labels)
    if mask:
        x = df.select(*by, F.explode(F.arrays_zip(pairs.alias("p"),
                                                 F.slice(F.col(mask), 2, F.size(mask) - 1).alias("m"))).alias("_z"))
        x = x.where(F.col("_z.m") == 1).select(*by, F.col("_z.p").alias("_p"))
    else:
        x = df.select(*by, F.explode(pairs).alias("_p"))
    hit = (F.col("_p.pred") == F.col("_p.label")).cast("double")
    agg = x.groupBy(*by) if by else x
    return agg.agg(F.count(F.lit(1)).alias("tokens"), F.avg(hit).alias("accuracy"))


def accuracy(df: DataFrame, pred: str, ref: str, normalize: bool = True,
             weight: str | None = None) -> DataFrame:
    """Share of matches; ``normalize=False`` gives the count of matches;
    ``weight`` gives the weighted share."""
    match = (F.col(pred) == F.col(ref))
    if weight:
        w = F.col(weight).cast("double")
        v = F.try_divide(F.sum(F.when(match, w).otherwise(0.0)), F.sum(w)) if normalize \
            else F.sum(F.when(match, w).otherwise(0.0))
    else:
        v = F.avg(match.cast("double")) if normalize else F.count_if(match).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), v.alias("accuracy"))


def pair_counts(blocks: DataFrame, by: Sequence[str] = (), ids_col: str = "input_ids") -> DataFrame:
    """(by..., a, b, m): how often token b follows token a inside a block."""
    z = F.explode(shifted_pairs(ids_col, ids_col)).alias("_p")
    return (blocks.select(*by, z)
                  .groupBy(*by, F.col("_p.pred").alias("a"), F.col("_p.label").alias("b"))
                  .agg(F.count(F.lit(1)).alias("m")))


def fit_bigram(train: DataFrame, ids_col: str = "input_ids") -> tuple[DataFrame, DataFrame, int]:
    """E5: pair counts c(a,b), the per-token model (n(a), most frequent next
    token, ties to the smaller id), and the vocabulary size V (distinct
    tokens in the training blocks)."""
    from quire.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(train.sparkSession)
    # the fitted counts are the model: written once (reliable checkpoint) and
    # read by the vocabulary count, the model table and the scoring joins
    pairs = pair_counts(train, ids_col=ids_col).withColumnRenamed("m", "c").checkpoint(eager=True)
    model = pairs.groupBy("a").agg(
        F.sum("c").alias("n_a"),
        F.max(F.struct(F.col("c"), (-F.col("b")).alias("nb"))).alias("_best"),
    ).select("a", "n_a", (-F.col("_best.nb")).alias("pred"))
    # every token of a block with two or more tokens is in some pair; a
    # one-token block adds its token alone
    lone = train.where(F.size(ids_col) == 1).select(F.col(ids_col)[0].alias("t"))
    toks = pairs.select(F.col("a").alias("t")).unionByName(pairs.select(F.col("b").alias("t"))).unionByName(lone)
    v = toks.agg(F.count_distinct("t")).first()[0]
    return pairs, model, int(v)


def score_bigram(test: DataFrame, pairs: DataFrame, model: DataFrame, vocab_size: int,
                 by: Sequence[str] = (), k: float = SMOOTHING, ids_col: str = "input_ids") -> DataFrame:
    """Per (by..., a, b): test count m, loss -ln((c+k)/(n_a+kV)) and whether
    the model's prediction for a is b. Pre-aggregated, ready to sum."""
    m = pair_counts(test, by=by, ids_col=ids_col)
    # the model has one row per distinct training token, so V bounds its size
    small = F.broadcast(model) if vocab_size <= MAX_BROADCAST_MODEL else model
    j = (m.join(pairs, on=["a", "b"], how="left")
          .join(small, on="a", how="left"))
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    n = F.coalesce(F.col("n_a"), F.lit(0)).cast("double")
    nll = -F.log((c + F.lit(k)) / (n + F.lit(k * vocab_size)))
    return j.select(*by, "a", "b", "m", nll.alias("nll"),
                    F.coalesce(F.col("pred") == F.col("b"), F.lit(False)).alias("hit"))


def summarise(scored: DataFrame, by: Sequence[str] = (), rollup: bool = False) -> DataFrame:
    """tokens, accuracy, eval loss and perplexity = exp(loss)."""
    aggs = [
        F.sum("m").cast("long").alias("tokens"),
        F.try_divide(F.sum(F.when(F.col("hit"), F.col("m")).otherwise(0)), F.sum("m")).alias("accuracy"),
        F.try_divide(F.sum(F.col("m") * F.col("nll")), F.sum("m")).alias("eval_loss"),
    ]
    g = scored.rollup(*by) if rollup else (scored.groupBy(*by) if by else scored)
    out = g.agg(*aggs)
    return out.withColumn("perplexity", F.exp("eval_loss"))


def metric_report(df: DataFrame, metrics: Mapping[str, Column], by: Sequence[str] = (),
                  rollup: bool = True) -> DataFrame:
    """Pluggable metrics (U2, E6): each named aggregate Column is computed per
    ``by`` group, with subtotals and a grand total when ``rollup``."""
    aggs = [c.alias(n) for n, c in metrics.items()]
    if not by:
        return df.agg(*aggs)
    return (df.rollup(*by) if rollup else df.groupBy(*by)).agg(*aggs)


def perplexity(df: DataFrame, nll: str = "nll", by: Sequence[str] = ()) -> DataFrame:
    """E3 on token rows: exp(mean nll); an overflow is +Infinity."""
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg(nll).alias("eval_loss")).withColumn("perplexity", F.exp("eval_loss"))


def metrics_long(df: DataFrame, phase: str, metrics: Sequence[str]) -> DataFrame:
    """Wide one-row metrics -> (phase, metric, value) rows (S11 input)."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return df.selectExpr(f"'{phase}' AS phase", f"stack({len(metrics)}, {stack}) AS (metric, value)")


def vector_bytes(df: DataFrame, col: str = "embedding", by: Sequence[str] = (),
                 bytes_per_element: int = 4) -> DataFrame:
    """Elements x bytes per element, per group and in total (rollup)."""
    n = F.size(col)
    return df.rollup(*by).agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.sum(n).cast("long").alias("n_elements"),
        (F.sum(n) * F.lit(bytes_per_element)).cast("long").alias("bytes"),
    )
