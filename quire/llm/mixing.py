"""Mixing sources to target weights by a low-discrepancy schedule
(DataFrame functions only).

The mix is a sequence of slots of ``BLOCK`` words. Slot ``i`` gets the golden
ratio point ``frac(i / phi)``, which the cumulative target shares map to a
source; the slots of a source are ranked, and slot ``r`` takes block
``r mod n_blocks`` of the source in pass ``r div n_blocks``. The blocks of a
source are cut, ``BLOCK`` words each, from its documents in a shuffled (hashed)
order. At most ``MAX_PASSES`` passes are made, so no document is taken more
often.

Nothing is ordered in one task: documents and slots are ranked within buckets
of bounded size, and only bucket totals are summed across buckets.

Defined cases: a null text has size 0; a null source is a source of its own,
last in the order; documents of size 0 and sources without words are kept with
taken 0; repeated rows are documents of their own; an empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir, frees_shuffles

WORD = r"[^\x20\x09-\x0D]+"
SPACED = r"[\x20\x09-\x0D]*" + WORD
BLOCK = 32
MAX_PASSES = 3
#: 2^31 / golden ratio, made odd: i -> i * STEP mod 2^31 is the golden sequence in integers.
STEP, MODULUS = 1327217885, 1 << 31
DOC_BUCKET, SLOT_BUCKET, SHARES = 1 << 12, 1 << 16, 1 << 12


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, key, source, size), sizes in words; key is a hash of id and text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "source", size.alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target, n_blocks), one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating. The targets
    share the whole size by weight; those above MAX_PASSES times their size
    stop there and the excess is shared again, which is: the smallest ratios
    of limit to weight stop first, until the level of the rest is below all
    their ratios."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = W.partitionBy(F.lit(0))
    ranked = per.select(
        "source", "source_size",
        ((F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1) % 3 + 1).alias("weight"))
    limit = F.col("source_size") * MAX_PASSES
    up = everything.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before = up.rowsBetween(W.unboundedPreceding, -1)
    levels = ranked.select(
        "*", ((F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
              / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"))
    stops = levels.select("*", (limit <= F.col("level") * F.col("weight")).alias("stops"))
    free = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    return stops.select(
        "source", "source_size", "weight",
        F.when(F.col("stops"), limit.cast("double")).otherwise(free * F.col("weight")).alias("target"),
        F.ceil(F.col("source_size") / BLOCK).cast("long").alias("n_blocks"))


def shuffled_offsets(sizes: DataFrame, n_docs: int) -> DataFrame:
    """``sizes`` with ``start``: the words of the source before the document in
    the hashed order. Buckets of that order hold about DOC_BUCKET documents;
    rows of equal id and text are one row with a count there, so that neither a
    repeated id nor a repeated row fills a bucket."""
    n_buckets = max(1, n_docs // DOC_BUCKET + 1)
    equal = sizes.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("copies"))
    keyed = equal.select("*", F.xxhash64("key").alias("h"), (F.col("size") * F.col("copies")).alias("all")).select(
        "*", F.floor(F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63)) * n_buckets).alias("bucket"))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("all").alias("total"))
    base = totals.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        (F.sum("total").over(W.partitionBy("source").orderBy("bucket")) - F.col("total")).alias("base"))
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "key", "size").rowsBetween(W.unboundedPreceding, 0)
    return (keyed.withColumn("upto", F.sum("all").over(inside))
            .join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .select("doc_id", "key", "source", "size", (F.col("base") + F.col("upto") - F.col("all")).alias("start"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth"))
            .select("doc_id", "key", "source", "size", (F.col("start") + F.col("nth") * F.col("size")).alias("start")))


def schedule(spark: SparkSession, targets: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source, pass, block): the slots of the mix in order."""
    shares = targets.where("target > 0").select("source", "n_blocks", "target", (
        F.sum("target").over(W.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source")))).alias("upto"),
        F.sum("target").over(W.partitionBy(F.lit(0))).alias("whole"))
    ends = shares.select(
        "source", "n_blocks",
        F.round((F.col("upto") - F.col("target")) / F.col("whole") * MODULUS).cast("long").alias("low"),
        F.round(F.col("upto") / F.col("whole") * MODULUS).cast("long").alias("high")).where("low < high")
    cell = MODULUS // SHARES
    cells = ends.select("*", F.explode(F.sequence(F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}"))).alias("cell"))
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), ((F.col("id") % MODULUS) * STEP % MODULUS).alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {cell}"))
    placed = slots.join(cells, "cell").where("low <= point and point < high").select(
        "slot", "source", "n_blocks", F.expr(f"slot div {SLOT_BUCKET}").alias("bucket"))
    totals = placed.groupBy("source", "bucket").agg(F.count("*").alias("total"))
    base = totals.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        (F.sum("total").over(W.partitionBy("source").orderBy("bucket")) - F.col("total")).alias("base"))
    ranked = (placed.withColumn("r", F.row_number().over(W.partitionBy("source", "bucket").orderBy("slot")))
              .join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
              .select("slot", "source", "n_blocks", (F.col("base") + F.col("r") - 1).alias("rank")))
    return (ranked.select("slot", "source", F.expr("rank div n_blocks").alias("pass"),
                          (F.col("rank") % F.col("n_blocks")).alias("block"))
            .where(F.col("pass") < MAX_PASSES))


def pieces(offsets: DataFrame) -> DataFrame:
    """(source, block, start, first, words): the words ``first`` .. of the
    document that starts at ``start``, which lie in ``block``."""
    cut = offsets.where("size > 0").select(
        "source", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * BLOCK)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return cut.select("source", "block", "start", (low - F.col("start")).alias("first"), (high - low).alias("words"))


@frees_shuffles
def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, key, source, size, taken, parts,
    source_size, target). ``parts`` are the pieces taken (first, words, times);
    their times do not grow along the document."""
    ensure_checkpoint_dir(spark)
    sizes = sized(docs).checkpoint()
    n_docs, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    targets = source_targets(sizes).checkpoint()
    offsets = shuffled_offsets(sizes, n_docs).checkpoint()  # read twice: one small plan instead of two copies in a large one
    slots = schedule(spark, targets, -(-total // BLOCK))
    times = slots.groupBy("source", "block").agg(F.count("*").alias("times"))
    cut = pieces(offsets)
    met = cut.join(times.select(F.col("source").alias("s"), F.col("block").alias("b"), "times"),
                   F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    per = met.groupBy("source", "start").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"),
        F.collect_list(F.struct("first", "words", "times")).alias("parts"))
    out = offsets.join(per.select(F.col("source").alias("s"), F.col("start").alias("o"), "taken", "parts"),
                       F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("o")) & (F.col("size") > 0), "left")
    return (out.select("doc_id", "key", "source", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "parts")
            .join(targets.select(F.col("source").alias("s"), "source_size", "target"),
                  F.col("source").eqNullSafe(F.col("s"))).drop("s"))


def mixed_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents of the mix, one row for every pass that takes words of a
    document, with the text of the words taken: the whole text, or the text up to
    the end of the last word taken where the last block of the mix ends in it. text and
    n_chars are those of the words taken, other columns stay. Rows of equal id and
    text get what the mix gives each of them, by source and one to one."""
    same = W.partitionBy("doc_id", "key", "source")  # rows that are equal but for columns the mix does not know
    taken = mix(spark, docs).where("taken > 0").withColumn("nth", F.row_number().over(same.orderBy(F.desc("taken")))) \
        .withColumn("parts", F.sort_array("parts"))
    times = F.transform("parts", lambda x: x["times"])
    passes = taken.select(
        F.col("doc_id").alias("i"), F.col("key").alias("k"), F.col("source").alias("s"), "nth", "size", "parts",
        F.explode(F.sequence(F.lit(1).cast("long"), F.array_max(times))).alias("pass"))
    words = passes.select("i", "k", "s", "nth", "size", F.aggregate(
        "parts", F.lit(0).cast("long"),
        lambda sum_, x: sum_ + F.when(x["times"] >= F.col("pass"), x["words"]).otherwise(F.lit(0).cast("long"))).alias("words"))
    packed = docs.select(F.struct(*docs.columns).alias("d"), F.xxhash64("doc_id", "text").alias("k2"))
    equal = W.partitionBy("k2", "d.doc_id", "d.source").orderBy(F.xxhash64("d"))
    met = packed.withColumn("at", F.row_number().over(equal)).join(
        words, F.col("d.doc_id").eqNullSafe(F.col("i")) & (F.col("k2") == F.col("k")) & F.col("d.source").eqNullSafe(F.col("s"))
        & (F.col("at") == F.col("nth")))
    text = F.when(F.col("words") == F.col("size"), F.col("d.text")).otherwise(F.array_join(
        F.slice(F.regexp_extract_all("d.text", F.lit(SPACED), F.lit(0)), F.lit(1), F.col("words").cast("int")), ""))
    made = met.withColumn("t", text)
    new = {"text": F.col("t"), "n_chars": F.length("t").cast("long")}
    return made.select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
