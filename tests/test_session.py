import time

import pytest
from pyspark.sql import functions as F

from quire.llm import kneser, minhash, mixing, repeats, toxicity
from quire.session import FREE_SHUFFLES, frees_shuffles


def shuffle_files(spark) -> set[str]:
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in names.split("\n") if "/shuffle_" in x and x.endswith(".data")}


def left_over(spark, work) -> tuple:
    """The result of ``work`` and the shuffle files of its jobs that stay; removal is not waited for by Spark."""
    held = shuffle_files(spark)
    out = work()
    until = time.time() + 20
    while (new := shuffle_files(spark) - held) and time.time() < until:
        time.sleep(0.2)
    return out, new


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"w{(i // 2) * 7 + k}" for k in range(60)), "en", "ab"[i % 2], 1) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "repeats", "mixing", "perplexity"])
def test_operators_leave_no_shuffle_files_of_their_jobs(spark, docs, name):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    work = {"toxicity": lambda: toxicity.scored(spark, docs, labels, ["doc_id"]),
            "near_duplicates": lambda: minhash.near_duplicates(spark, docs), "repeats": lambda: repeats.remove_repeats(spark, docs),
            "mixing": lambda: mixing.mix(spark, docs), "perplexity": lambda: kneser.judge(spark, docs, labels)}[name]
    out, new = left_over(spark, work)
    assert not new
    first = sorted(map(str, out.collect()))
    assert len(first) == 40 and sorted(map(str, out.collect())) == first  # the result may be used again


def test_setting_is_given_back(spark):
    seen = []

    @frees_shuffles
    def work(session, fail):
        seen.append(session.conf.get(FREE_SHUFFLES))
        if fail:
            raise ValueError("no")
        return session.range(5).groupBy((F.col("id") % 2).alias("k")).count()

    for before in (None, "false", "true"):
        if before:
            spark.conf.set(FREE_SHUFFLES, before)
        assert work(spark, False).count() == 2
        with pytest.raises(ValueError):
            work(spark, True)
        assert spark.conf.get(FREE_SHUFFLES, None) == before
    spark.conf.unset(FREE_SHUFFLES)
    assert seen == ["true"] * 6
