"""String functions against Python's own behaviour."""
from pyspark.sql import functions as F

from quire.functions import text as tx

SAMPLES = ["  a b  ", "　x　", "\x1cy\x1f", "བོད་།\n", "", "\t\n", "z ",
           " q ", "mid  space", "\U0001F600 ", "\x85w​"]


def test_py_strip_matches_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", tx.py_strip("s").alias("t")).collect()}
    assert got == {i: s.strip() for i, s in enumerate(SAMPLES)}
    every = "".join(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000)
    ws = "".join(c for c in every if c.isspace())
    df2 = spark.createDataFrame([(ws + "x" + ws,)], "s string")
    assert df2.select(tx.py_strip("s")).first()[0] == "x"


def test_prompt_and_answers(spark):
    df = spark.createDataFrame([("Why?",)], "q string")
    prompt = df.select(tx.render_prompt("q")).first()[0]
    assert prompt.startswith("<|start_header_id|>system<|end_header_id|>\n\n" + tx.DEFAULT_SYSTEM_PROMPT)
    assert prompt.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")
    raw = spark.createDataFrame([("system\n\nS user\n\nQ assistant\n\n  A1 assistant\n\n A2 ",), ("no marker",)],
                                "o string")
    rows = raw.select(tx.extract_answer("o", "second").alias("s"), tx.extract_answer("o", "last").alias("l")).collect()
    assert (rows[0].s, rows[0].l) == ("A1", "A2")
    assert (rows[1].s, rows[1].l) == (None, "no marker")


def test_cut_at_stop_and_keys(spark):
    df = spark.createDataFrame([("ab<|end_of_text|>c<|eot_id|>d",), ("plain",), ("<|eot_id|>x",)], "s string")
    assert [r[0] for r in df.select(tx.cut_at_stop("s")).collect()] == ["ab", "plain", ""]
    names = spark.createDataFrame([("a.b.txt",), ("ab.txt",), ("noext",), (".txt",)], "n string")
    assert [r[0] for r in names.select(tx.source_key("n")).collect()] == ["ab", "ab", "", ""]
