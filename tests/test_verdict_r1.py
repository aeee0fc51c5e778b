"""Cases found by review: files that change, NULL groups, gaps, repeats."""
import os

import pytest
from pyspark.sql import functions as F

from quire.functions.text import ANSWER_MARKER
from quire.operators import dataset, infer, keyed, pack
from quire.operators import unigram as ug
from quire.sources.corpus import scan_corpus


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_scan_append_scan_again_in_one_session(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        name = str(tmp_path / "a.txt")
        lines = [f"line {i} " + "x" * (i % 50) for i in range(2000)]
        write(name, lines)
        first = scan_corpus(spark, str(tmp_path))
        assert [r.text for r in first.orderBy("line_no").collect()] == lines
        for change in (lines + [f"more {i}" for i in range(1000)], ["top"] + lines):
            write(name, change)
            os.utime(name, (1, os.stat(name).st_size))
            got = scan_corpus(spark, str(tmp_path)).orderBy("line_no").collect()
            assert [r.text for r in got] == change and [r.line_no for r in got] == list(range(len(change)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_accounting_of_a_null_source(spark):
    tokens = spark.createDataFrame([(None, [1] * 7, 1), ("a", [2] * 5, 2)], "source string, input_ids array<int>, doc_id long")
    blocks = spark.createDataFrame([(None, [1] * 4), (None, [1, 1, 1, 0]), ("a", [1] * 4)], "source string, attention_mask array<int>")
    got = {r.source: (r.tokens_in, r.tokens_kept, r.n_blocks) for r in pack.accounting(tokens, blocks).collect()}
    assert got == {None: (7, 7, 2), "a": (5, 4, 1)}


def test_ragged_in_a_later_column(spark):
    df = spark.createDataFrame([(0, [1, 2], [1, 1]), (1, [3, 4], [1])], "idx long, input_ids array<int>, attention_mask array<int>")
    with pytest.raises(Exception, match="ragged"):
        dataset.batch(df, 2, ["idx"], cols=("input_ids", "attention_mask")).collect()
    row = dataset.batch(df, 2, ["idx"], ragged="first", cols=("input_ids", "attention_mask")).first()
    assert row.ragged and row.attention_mask == [[1, 1], [1, 1]]


def test_turn_pairs_with_gaps(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q"), (1, 2, "assistant", "a"), (1, 5, "user", "alone")],
                                 "conv_id long, turn long, role string, text string")
    assert [(r.question, r.answer) for r in infer.turn_pairs(conv, dense=False).collect()] == [("q", "a")]


def test_other_roles_fail_instead_of_vanishing(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "tool", "x")], "conv_id long, turn long, role string, text string")
    with pytest.raises(Exception, match="no chat format"):
        infer.render_chat(conv).collect()


def test_answer_only_model(spark):
    q = spark.createDataFrame([(0, "why")], "idx long, question string")
    assert infer.answer_pipeline(q, lambda: lambda p: ["because"] * len(p), output="answer").first().Output == "because"
    full = infer.answer_pipeline(q, lambda: lambda p: [x + ANSWER_MARKER + " so" for x in ["p"] * len(p)])
    assert full.first().Output == "so"


def test_repeated_patch_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    patch = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    for call in (lambda: keyed.override(base, patch, ["k"], ["v"]), lambda: keyed.override_fields(base, patch, ["k"], {"v": F.lit("z")})):
        with pytest.raises(Exception, match="repeats"):
            call().collect()
    assert sorted(map(tuple, keyed.override(base, patch.limit(1), ["k"], ["v"]).collect())) == [(1, patch.first().v), (2, "b")]


def test_unigram_long_pieces_nul_and_small_targets(spark):
    vocab = spark.createDataFrame([(0, "<unk>", 0.0), (1, "<s>", 0.0), (2, "</s>", 0.0), (3, "internationalisation", -1.0), (4, "i", -3.0)],
                                  "id int, piece string, score double")
    df = spark.createDataFrame([("internationalisation",)], "text string")
    assert ug.tokenise_unigram(df, vocab, bos=False, eos=False).first().input_ids == [3]
    text = spark.createDataFrame([("a\0b c x \0b",)], "text string")
    words = {r.word for r in ug.word_counts(text).collect()}
    assert words == set(ug.pre_tokens("a\0b c x \0b"))
    with pytest.raises(ValueError, match="distinct characters"):
        ug.train_unigram(spark.createDataFrame([("abcdefghijklmnop",)], "text string"), 8)


def cached(spark, root, rows, **kw):
    from quire.operators.tokenise import codepoint_size, tokenise_codepoint
    from quire.sources.sinks import materialise
    lines = spark.createDataFrame(rows, "source string, line_no long, text string")
    built = []

    def build(todo):
        built.extend(r.source for r in todo.select("source").distinct().collect())
        return pack.pack(todo, block=8, order=["line_no"], remainder="drop", tokenise=tokenise_codepoint, size=codepoint_size("text"))

    blocks, manifest = materialise(lines, build, root, 8, "cp", **kw)
    got = {}
    for r in blocks.collect():
        got[r.source] = got.get(r.source, 0) + 1
    said = {r.source: r.rows for r in manifest.collect()}
    assert said == {**{r[0]: 0 for r in rows}, **got}
    return got, sorted(map(str, built))


def test_cache_names_shrinking_and_crash(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "cache")
    rows = [(s, i, "some text of a line") for s in ("001", "1", "", None, "a=b/c") for i in range(3)]
    first, built = cached(spark, root, rows)
    assert set(first) == {"001", "1", "", None, "a=b/c"} and len(built) == 5
    assert cached(spark, root, rows) == (first, [])
    shrunk = [r for r in rows if r[0] != "1"] + [("1", 0, "x")]
    second, built = cached(spark, root, shrunk)
    assert "1" not in second and built == ["1"]
    assert cached(spark, root, shrunk) == (second, [])

    def crash(*a, **k):
        raise RuntimeError("lost")
    from quire.sources import sinks
    with monkeypatch.context() as m:
        m.setattr(sinks.uuid, "uuid4", crash)
        with pytest.raises(RuntimeError):
            cached(spark, root, rows)
    assert cached(spark, root, shrunk) == (second, [])
    assert cached(spark, root, rows)[0] == first
    assert cached(spark, root, rows[:3])[0] == {"001": first["001"]}
    assert cached(spark, root, rows, overwrite=True)[1] == sorted(["001", "1", "", "None", "a=b/c"])
