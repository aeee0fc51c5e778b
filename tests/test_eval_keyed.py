"""Evaluation, keyed merges and vocabulary on hand-made fixtures (FIXTURES 3)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.arrays import argmax, drop_special, label_typing
from quire.operators import evaluate as ev
from quire.operators import keyed
from quire.operators import tokenise as tk
from quire.operators import vocab as vc


def test_token_accuracy_fixture(spark):
    rows = [(1, [5, 6, 7], [0, 5, 6], 1.0),      # all right after the shift
            (2, [1, 1, 1], [2, 2, 2], 1.0),      # all wrong
            (3, [9], [9], 1.0),                  # length 1: no pair
            (4, [3, 4], [0, 3], 0.0)]            # right, weight 0
    df = spark.createDataFrame(rows, "seq_id bigint, preds array<int>, labels array<int>, weight double")
    r = ev.token_accuracy(df).first()
    assert (r.tokens, r.accuracy) == (5, 3 / 5)
    by = {x.seq_id: x for x in ev.token_accuracy(df, by=["seq_id"]).collect()}
    assert 3 not in by and by[1].accuracy == 1.0 and by[2].accuracy == 0.0
    masked = ev.token_accuracy(df.withColumn("m", F.array(F.lit(1), F.lit(0), F.lit(1))).where("seq_id = 1"),
                               mask="m").first()
    assert masked.tokens == 1


def test_accuracy_options(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (0, 1, 0.0), (1, 0, 1.0), (0, 0, 1.0)], "p int, r int, w double")
    assert ev.accuracy(df, "p", "r").first().accuracy == 0.5
    assert ev.accuracy(df, "p", "r", normalize=False).first().accuracy == 2.0
    assert ev.accuracy(df, "p", "r", weight="w").first().accuracy == 3.0 / 4.0


def test_argmax_fixture(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 3.0]), (2, [-5.0, -1.0, -2.0]), (3, [1.0, float("nan"), 2.0]),
                                (4, [])], "k int, v array<float>")
    got = {r.k: r.a for r in df.select("k", argmax("v").alias("a")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: None}


def test_perplexity_overflow(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 4.0), (2, 0, 710.0)], "seq_id bigint, pos int, nll double")
    by = {r.seq_id: r.perplexity for r in ev.perplexity(df, by=["seq_id"]).collect()}
    assert math.isclose(by[1], math.exp(3.0)) and by[2] == float("inf")


def test_bigram_against_python(spark):
    train = [[1, 2, 3, 1, 2, 4], [2, 3]]
    test = [[1, 2, 3, 9]]
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "k int, input_ids array<int>")
    sdf = spark.createDataFrame([(i, t) for i, t in enumerate(test)], "k int, input_ids array<int>")
    pairs, model, v = ev.fit_bigram(tdf)
    s = ev.summarise(ev.score_bigram(sdf, pairs, model, v)).first()
    assert v == 4
    c = {(1, 2): 2, (2, 3): 2, (3, 1): 1, (2, 4): 1}
    n = {1: 2, 2: 3, 3: 1}
    nll = [-math.log((c.get((a, b), 0) + 1) / (n.get(a, 0) + 4)) for a, b in [(1, 2), (2, 3), (3, 9)]]
    assert math.isclose(s.eval_loss, sum(nll) / 3) and s.tokens == 3
    assert math.isclose(s.accuracy, 2 / 3)                # preds: 1->2, 2->3, 3->1


def test_label_typing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.5)], "a int, b double")
    got = {r.column: r.target_type for r in label_typing(df, ["a", "b"]).collect()}
    assert got == {"a": "bigint", "b": "double"}


def test_override_and_fields(spark):
    base = spark.createDataFrame([(1, [1.0, 1.0], 0), (2, [2.0, 2.0], 1)], "vec_id bigint, embedding array<float>, label int")
    patch = spark.createDataFrame([(2, [9.0, 9.0], 7), (5, [5.0, 5.0], 5)], "vec_id bigint, embedding array<float>, label int")
    o = {r.vec_id: (list(r.embedding), r.label) for r in keyed.override(base, patch, ["vec_id"], ["embedding"]).collect()}
    assert o == {1: ([1.0, 1.0], 0), 2: ([9.0, 9.0], 1)}
    f = {r.vec_id: r.label for r in keyed.override_fields(base, patch, ["vec_id"], {"label": F.lit(-1)}).collect()}
    assert f == {1: -1, 2: 7}


def test_last_wins_text_order(spark):
    parts = spark.createDataFrame([("L2-x", "k", 2), ("L10-x", "k", 10), ("L10-x", "j", 1)],
                                  "part string, key string, value bigint")
    got = {r.key: (r.part, r.value) for r in keyed.last_wins(parts, ["key"], "part", ["value"]).collect()}
    assert got == {"k": ("L2-x", 2), "j": ("L10-x", 1)}
    assert parts.where(keyed.name_filter("part", r"L(\d+)-")).count() == 3
    assert parts.where(keyed.name_filter("part", r"x")).count() == 0


def test_low_rank(spark):
    rng = np.random.default_rng(0)
    e = rng.normal(size=(6, 5)).astype(np.float32)
    df = spark.createDataFrame([(i, e[i].tolist()) for i in range(6)], "vec_id bigint, embedding array<float>")
    for r in (1, 4):
        a, b = rng.normal(size=(r, 5)), rng.normal(size=(5, r))
        out = {x.vec_id: np.array(x.embedding) for x in keyed.apply_low_rank(df, a, b, 3.0, r).collect()}
        for i in range(6):
            want = e[i].astype(np.float64) + (3.0 / r) * (b @ (a @ e[i].astype(np.float64)))
            assert np.allclose(out[i], want)
        tr = {x.vec_id: np.array(x.embedding) for x in keyed.apply_low_rank(df, a, b, 3.0, r, transpose=True).collect()}
        for i in range(6):
            assert np.allclose(tr[i], e[i] + (3.0 / r) * ((b @ a).T @ e[i].astype(np.float64)))
    same = keyed.apply_low_rank(df, np.ones((2, 5)), np.ones((5, 2)), 0.0, 2).collect()
    assert all(np.allclose(x.embedding, e[x.vec_id]) for x in same)
    with pytest.raises(ValueError):
        keyed.apply_low_rank(df, np.ones((2, 5)), np.ones((4, 2)), 1.0, 2)


def test_vocab_extend_and_check(spark):
    base = spark.createDataFrame([(0, "<unk>", 0.0), (1, "ཀ་", 1.0), (2, "a", 1.0)], "id int, piece string, score double")
    new = spark.createDataFrame([(0, "a", 1.0), (1, "\U00020000", 2.0), (2, "ཁ་", 1.0), (3, "\U00020000", 0.5)],
                                "id int, piece string, score double")
    ext = {r.piece: r.id for r in vc.extend_vocab(base, new).collect()}
    assert ext == {"<unk>": 0, "ཀ་": 1, "a": 2, "\U00020000": 3, "ཁ་": 4}
    rep = vc.check_vocab(vc.extend_vocab(base, new), 5).first()
    assert rep.ok and rep.n_entries == 5
    assert not vc.check_vocab(base, 56724).first().ok


def test_codepoint_and_word_tokenizers(spark):
    texts = [(0, "ཀ་ཁ་། \U0001F600 é"), (1, ""), (2, "  lead  trail  "), (3, "b a b")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    for engine in ("sql", "arrow"):
        t = tk.tokenise_codepoint(df, engine=engine)
        rows = {r.doc_id: r for r in t.select("doc_id", "input_ids", tk.decode_codepoint("input_ids").alias("d")).collect()}
        arrow = {r.doc_id: r.text for r in tk.decode_codepoint_arrow(t).collect()}
        for i, s in texts:
            assert rows[i].d == s and arrow[i] == s
            assert list(rows[i].input_ids) == [tk.CP_BOS] + [ord(c) for c in s] + [tk.CP_EOS]
    v = tk.word_vocab(df, 5)
    assert [(r.id, r.piece) for r in v.orderBy("id").collect()] == [(0, "<unk>"), (1, "<s>"), (2, "</s>"), (3, "b"), (4, "a")]
    w = {r.doc_id: list(r.input_ids) for r in tk.tokenise_word(df, v).collect()}
    assert w[1] == [1, 2] and w[3] == [1, 3, 4, 3, 2] and w[2] == [1, 0, 0, 2]
    dec = {r.doc_id: r.text for r in tk.decode_word(tk.tokenise_word(df, v), v).collect()}
    assert dec[3] == "b a b" and dec[2] == "<unk> <unk>" and dec[1] == ""
    ids = spark.createDataFrame([([1, 5, 2, 5, 1],)], "ids array<int>")
    assert ids.select(drop_special("ids", [1, 2])).first()[0] == [5, 5]
    look = tk.token_ids(spark.createDataFrame([("a",), ("zz",)], "piece string"), v)
    assert {r.piece: r.id for r in look.collect()} == {"a": 4, "zz": 0}


def test_zero_weights_give_null_not_error(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (0, 1, 0.0)], "p int, r int, w double")
    assert ev.accuracy(df, "p", "r", weight="w").first().accuracy is None


def test_metric_report_pluggable(spark):
    df = spark.createDataFrame([("a", "x", 1, 1), ("a", "y", 0, 1), ("b", "x", 1, 1)], "g string, h string, p int, r int")
    rep = ev.metric_report(df, {"n": F.count(F.lit(1)), "acc": F.avg((F.col("p") == F.col("r")).cast("double"))}, by=["g"])
    got = {r.g: (r.n, r.acc) for r in rep.collect()}
    assert got == {"a": (2, 0.5), "b": (1, 1.0), None: (3, 2 / 3)}
    flat = ev.metric_report(df, {"n": F.count(F.lit(1))}, by=["g", "h"], rollup=False)
    assert flat.count() == 3
