"""Block packing (P1-P4): concatenate token lists in order and cut them into
blocks of ``block`` tokens.

Shuffled rows are (document, block) slices, never single tokens:

* each row's token offset inside its group comes from
  :func:`quire.operators.index.dense_index` (bucketed running sum);
* a row spanning blocks b0..b1 emits one slice per block
  (``explode(sequence(b0, b1))`` + ``slice``);
* slices are regrouped by (group, block) and concatenated in offset order. A
  block has at most ``block`` slices, so no group is unbounded.

Remainder rule (``remainder="reference"``): a group keeps only full blocks,
unless it has fewer than ``block`` tokens in total, in which case its single
short block is kept. Block 0 is short exactly when the group total is below
``block``, so the rule is ``n == block OR block_id == 0``; no group total is
needed. ``"drop"`` keeps full blocks only, ``"keep"`` keeps every block,
``"pad"`` keeps every block and pads the short one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import ones_like
from quire.operators.index import DEFAULT_BUCKET_ROWS, dense_index

REMAINDERS = ("reference", "drop", "keep", "pad")
LABEL_PAD = -100


def effective_block_size(block: int | None, model_max: int | None) -> int:
    """``min(block, model_max)``; with no block given, ``min(model_max, 1024)``."""
    if block is None:
        if model_max is None:
            raise ValueError("give a block size or the model's maximum length")
        return min(model_max, 1024)
    return block if model_max is None else min(block, model_max)


def _slices(df: DataFrame, keys: Sequence[str], block: int, ids_col: str) -> DataFrame:
    """One row per (row, block it touches): (keys, b, lo, part)."""
    off, n = F.col("_off"), F.size(ids_col)
    b = F.col("_b")
    lo = F.greatest(off, b * block)
    hi = F.least(off + n, (b + 1) * block)
    return (df.where(n > 0)
              .select(*keys, "_off", ids_col,
                      F.explode(F.sequence(F.floor(off / block), F.floor((off + n - 1) / block))).alias("_b"))
              .select(*keys, b.cast("long").alias("_b"), lo.alias("_lo"),
                      F.slice(ids_col, (lo - off + 1).cast("int"), (hi - lo).cast("int")).alias("_part")))


def _assemble(slices: DataFrame, keys: Sequence[str], block: int, remainder: str,
              pad_id: int) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("_lo", "_part")))
    blocks = (slices.groupBy(*keys, "_b")
                    .agg(parts.alias("_parts"))
                    .select(*keys, "_b", F.flatten(F.transform("_parts", lambda s: s["_part"])).alias("input_ids")))
    n = F.size("input_ids")
    if remainder == "reference":
        blocks = blocks.where((n == block) | (F.col("_b") == 0))
    elif remainder == "drop":
        blocks = blocks.where(n == block)
    elif remainder not in ("keep", "pad"):
        raise ValueError(f"remainder must be one of {REMAINDERS}")
    mask = ones_like("input_ids")
    labels = F.col("input_ids")
    if remainder == "pad":
        short = F.lit(block) - n
        mask = F.concat(mask, F.array_repeat(F.lit(0), short))
        labels = F.concat(labels, F.array_repeat(F.lit(LABEL_PAD), short))
        ids = F.concat(F.col("input_ids"), F.array_repeat(F.lit(pad_id), short))
        return blocks.select(*keys, "_b", ids.alias("input_ids"), mask.alias("attention_mask"),
                             labels.alias("labels"))
    return blocks.select(*keys, "_b", "input_ids", mask.alias("attention_mask"), labels.alias("labels"))


def _tokenise_late(df: DataFrame, tokenise, expected: str, ids_col: str) -> DataFrame:
    """Tokenise after the offsets are known; fail loudly if the token count
    differs from the size expression the offsets were computed with."""
    t = tokenise(df)
    ok = F.size(ids_col) == F.col(expected)
    return t.withColumn(ids_col, F.when(ok, F.col(ids_col)).otherwise(
        F.raise_error(F.lit("token count differs from the size expression given to pack")))).drop(expected)


def pack(df: DataFrame, block: int = 256, mode: str = "global", remainder: str = "reference",
         group: Sequence[str] = ("source",), order: Sequence[str] = ("doc_id",),
         ids_col: str = "input_ids", workers: int = 8, batch_rows: int = 1000,
         pad_id: int = 0, bucket_rows: int = DEFAULT_BUCKET_ROWS,
         bucket: Sequence | None = None, tokenise=None, size: Column | None = None,
         text_col: str = "text") -> DataFrame:
    """Pack token lists into blocks. Output: group columns, ``block_id``,
    ``input_ids``, ``attention_mask``, ``labels`` (labels copy the ids, F10).

    ``mode="global"``: one concatenation per group; independent of any
    worker count. ``mode="batch"``: the group is cut into ``workers``
    contiguous shards and each shard into batches of ``batch_rows`` rows; the
    remainder rule applies per batch (the reference's per-map-batch rule).

    With ``tokenise`` and ``size`` (a cheap Column giving each text's token
    count, e.g. :func:`quire.operators.tokenise.codepoint_size`), ``df``
    holds text: offsets are computed from ``size``, the text (smaller than
    its ids) is what gets shuffled, and tokenisation runs once, after the
    shuffle."""
    if block < 1 or workers < 1 or batch_rows < 1:
        raise ValueError("block, workers and batch_rows must be at least 1")
    group, order = list(group), list(order)
    late = tokenise is not None
    if late and size is None:
        df, late = tokenise(df), False
    payload = text_col if late else ids_col
    base = df.select(*group, *order, payload)
    n_expr = size if late else F.size(ids_col)
    if mode == "global":
        idx = dense_index(base.withColumn("_exp", n_expr), order=order, group=group, size=F.col("_exp"),
                          bucket=bucket, bucket_rows=bucket_rows, offset_col="_off")
        if late:
            idx = _tokenise_late(idx, tokenise, "_exp", ids_col)
        out = _assemble(_slices(idx, group, block, ids_col), group, block, remainder, pad_id)
        return out.withColumnRenamed("_b", "block_id")
    if mode != "batch":
        raise ValueError("mode must be 'global' or 'batch'")

    idx = dense_index(base, order=order, group=group, bucket=bucket, bucket_rows=bucket_rows,
                      idx_col="_i", group_rows_col="_n")
    i, n = F.col("_i"), F.col("_n")
    w = F.least(F.lit(workers), n)
    q, m = F.floor(n / w), n % w
    big = m * (q + 1)
    shard = F.when(i < big, F.floor(i / (q + 1))).otherwise(m + F.floor((i - big) / q))
    start = F.when(shard < m, shard * (q + 1)).otherwise(big + (shard - m) * q)
    keyed = (idx.withColumn("_shard", shard.cast("long"))
                .withColumn("_batch", F.floor((i - start) / batch_rows).cast("long")))
    bkeys = group + ["_shard", "_batch"]
    within = Window.partitionBy(*bkeys).orderBy(*order)
    keyed = keyed.withColumn("_exp", n_expr)
    keyed = keyed.withColumn(
        "_off", F.sum("_exp").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_exp"))
    if late:
        keyed = _tokenise_late(keyed, tokenise, "_exp", ids_col)
    local = _assemble(_slices(keyed, bkeys, block, ids_col), bkeys, block, remainder, pad_id)
    # dense block ids per group: blocks of earlier (shard, batch) come first.
    # A batch's block count follows from its token total and the remainder
    # rule, so it is computed from sizes alone (no second pass over blocks).
    total = F.sum("_exp")
    full = F.floor(total / block)
    if remainder == "reference":
        k = F.when(total >= block, full).when(total > 0, F.lit(1)).otherwise(F.lit(0))
    elif remainder == "drop":
        k = full
    else:
        k = F.ceil(total / block)
    sizes = idx.withColumn("_shard", shard.cast("long")) \
               .withColumn("_batch", F.floor((i - start) / batch_rows).cast("long")) \
               .withColumn("_exp", n_expr)
    per_batch = sizes.groupBy(*bkeys).agg(k.cast("long").alias("_k"))
    before = Window.partitionBy(*group).orderBy("_shard", "_batch").rowsBetween(Window.unboundedPreceding, -1)
    per_batch = per_batch.select(*bkeys, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    pb = per_batch.select(*[F.col(k).alias(f"_pb{k}") for k in bkeys], "_base")
    cond = [local[k].eqNullSafe(pb[f"_pb{k}"]) for k in bkeys]      # NULL sources keep their blocks
    return (local.join(pb, on=cond)
                 .select(*group, (F.col("_base") + F.col("_b")).alias("block_id"),
                         "input_ids", "attention_mask", "labels"))


def accounting(tokens: DataFrame, blocks: DataFrame, group: Sequence[str] = ("source",)) -> DataFrame:
    """Tokens in, kept (real tokens in blocks) and dropped, per group."""
    group = list(group)
    t_in = tokens.groupBy(*group).agg(F.sum(F.size("input_ids")).cast("long").alias("tokens_in"))
    kept = blocks.groupBy(*group).agg(
        F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)).cast("long").alias("tokens_kept"),
        F.count(F.lit(1)).alias("n_blocks"))
    kept = kept.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)], "tokens_kept", "n_blocks")
    same = [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(group)]   # a NULL source keeps its blocks
    return (t_in.join(kept, on=same, how="left")
                .select(*group, "tokens_in",
                        F.coalesce("tokens_kept", F.lit(0)).alias("tokens_kept"),
                        (F.col("tokens_in") - F.coalesce("tokens_kept", F.lit(0))).alias("tokens_dropped"),
                        F.coalesce("n_blocks", F.lit(0)).alias("n_blocks")))
