"""Training-data pipeline over ``documents``: toxicity, near duplicates,
repeated passages, mixing, encoding. Each stage is written as Parquet in the
shared scratch folder and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, minhash, mixing, repeats, toxicity
from quire.session import frees_shuffles, scratch_path
from quire.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below the threshold."""
    scored = toxicity.scored(spark, docs.select(COLUMNS), table(spark, sf_dir, "labels"), COLUMNS)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(COLUMNS)


@frees_shuffles
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five words, likeness 0.8 or more), that of
    the smallest doc_id. Rows are judged one by one: those without an id, or
    with one that others have too, go by a hash of all their columns, after the
    others. Rows that are equal in all columns are one."""
    docs = docs.select(COLUMNS)
    again = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("again"))
    own = F.shiftrightunsigned(F.xxhash64(*COLUMNS), 2) + (1 << 62)
    if again.isEmpty():  # no id to look up
        marked = docs.withColumn("row", F.coalesce("doc_id", own))
    else:
        marked = docs.join(again, F.col("doc_id") == F.col("again"), "left").withColumn(
            "row", F.when(F.col("again").isNull(), F.coalesce("doc_id", own)).otherwise(own)).drop("again")
    kept = minhash.near_duplicates(spark, marked.select(F.col("row").alias("doc_id"), "text"), words=5, percent=80)
    stay = marked.join(kept.where("kept").select(F.col("doc_id").alias("row")).distinct(), "row", "left_semi")
    hashed = ~F.col("row").eqNullSafe(F.col("doc_id"))
    return stay.where(~hashed).select(COLUMNS).unionByName(stay.where(hashed).dropDuplicates(["row"]).select(COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without their repeated passages."""
    done = repeats.remove_repeats(spark, docs, ("lang", "source"))
    return done.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                       F.coalesce(F.length("kept_text"), F.lit(0)).cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each pass over a document."""
    return mixing.mixed_texts(spark, docs.select(COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as little-endian unsigned 32-bit integers, and
    the text that they stand for."""
    done = bpe.encode(spark, docs.select(COLUMNS))
    return done.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can express neither the learned rules nor the encoding; tests compare the stages with brute force.
ORACLE_SQL = None


@frees_shuffles
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
