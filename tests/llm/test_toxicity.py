import itertools
import math
import random
import zlib

import numpy as np
import pytest

from quire.llm import toxicity

PLAIN = "the garden was quiet and every visitor stood near water watching birds drift over green fields until evening".split()
BAD = ["idiot", "moron", "worthless"]


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(5)
    docs, labels = [], []
    for i in range(600):
        words = [r.choice(PLAIN) if r.random() < 0.7 else r.choice("aeiou").join(r.sample("bcdfglmnprst", 3)) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words.insert(r.randrange(40), BAD[i // 5 % 3])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def channel(corpus):
    return toxicity.Channel(toxicity.character_model(corpus[0]))


@pytest.mark.parametrize("token, plain", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("i d i o t", "idiot"), ("m o r 0 n", "moron"),
    ("w0rthl3$s", "worthless"), ("iidd1oott", "idiot"), ("mor*n", "moron")])
def test_restores(channel, token, plain):
    assert channel.restore(token) == plain


def path_score(channel, letters, cost):
    """Score of one reading: letters in words, spaces in a row as one, a space at the end."""
    size, state, total = toxicity.SYMBOLS, (0, 0, 0), cost
    for ch in letters + " ":
        c = ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch != " " else 0
        if c or any(state):
            total += channel.model[((state[0] * size + state[1]) * size + state[2]) * size + c]
        state = (*state[1:], c) if c else (0, 0, 0)
    return total


@pytest.mark.parametrize("token", ["1d10t", "id!1ot", "m0rr0n", "w*rth", "i.d-i o", "a$$", "66 7", "m # r o n", "bb..ee", "é1l", "|+|", "%", "  a"])
def test_decodes_the_best_of_all_readings(channel, token):
    readings = {}
    for path in itertools.product(*channel.slots(token)):
        letters = "".join(x for x, _ in path)
        readings[letters] = max(readings.get(letters, -1e9), path_score(channel, letters, sum(c for _, c in path)))
    got = channel.decode(channel.slots(token))
    assert got in readings and readings[got] == pytest.approx(max(readings.values()), abs=1e-6)


def wilson(k, n, z=1.64):
    p, n = k / max(n, 1), max(n, 1)
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def test_rules_are_those_of_a_plain_greedy(spark, corpus):
    docs, labels = corpus
    model = spark.sparkContext.broadcast(toxicity.character_model(docs).tobytes())
    names, shares, rest = toxicity.learn_rules(spark, docs, labels, model)
    free = labels.where(~toxicity.held_out(toxicity.F.col("doc_id")))
    rows = sorted(toxicity.labelled_features(docs.join(free, "doc_id"), model).collect(), key=lambda r: r.doc_id)
    first = {}
    for r in rows:
        first.setdefault((r["copy"], r.toxic), r)
    rows, holds = list(first.values()), {}
    for i, r in enumerate(rows):
        for f in r.features:
            holds.setdefault(f, set()).add(i)
    weight, picked, want = [1.0] * len(rows), [], []
    while True:
        best = (0.0, 0, 0.0)
        for f in sorted(holds):
            k, n = sum(rows[i].toxic for i in holds[f]), len(holds[f])
            left = sum(weight[i] for i in holds[f] if rows[i].toxic)
            if f in picked or k < toxicity.SUPPORT or 2 * k < n or left < toxicity.SUPPORT / 2 or wilson(k, n) < toxicity.LEAST_SHARE:
                continue
            new = wilson(left, left + n - k)
            if new >= toxicity.LEAST_SHARE and left * new > best[0] + 1e-12:
                best = (left * new, f, wilson(k, n))
        if not best[0]:
            break
        picked.append(best[1])
        want.append(best[2])
        for i in holds[best[1]]:
            weight[i] /= 4
    met = [i for i in range(len(rows)) if weight[i] == 1]
    assert len(picked) >= 3 and names.tolist() == picked and shares.tolist() == pytest.approx(want)
    assert rest == pytest.approx(sum(rows[i].toxic for i in met) / max(len(met), 1))


def test_model_is_a_distribution(corpus):
    p = np.exp(toxicity.character_model(corpus[0]).reshape(-1, toxicity.SYMBOLS))
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_scores_hidden_words_and_leaves_clean_ones(spark, corpus):
    docs, labels = corpus
    more = [(1000, "the garden 1d10t was quiet"), (1001, "you i d i o t go"), (1002, "M0R0N"), (1003, "a quiet garden"), (1004, ""),
            (1005, None), (1006, "w.o.r.t.h.l.e.s.s garden"), (1007, "an evening near water 2024 mail4 a@b.example.com")]
    rows = {r.doc_id: r for r in toxicity.score(
        spark, docs.unionByName(spark.createDataFrame(more, docs.schema)), labels).collect()}
    assert [rows[i].predicted for i in range(1000, 1008)] == [1, 1, 1, 0, 0, 0, 1, 0]
    truth = dict(labels.collect())
    assert sum(rows[i].predicted != t for i, t in truth.items()) <= 6
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 for r in rows.values())


HIDDEN = ["mor-on", "i..d..i..o..t", "1.d.1.0.t", "m.0.r.0.n", "iiddiioott", "moroon", "id io t", "m ó r o n".replace("ó", "0"),
          "i d * o t", "i - d - i - o - t", "worthle$$", "m # r o n", "mo ro n"]


def test_scores_every_hidden_form(spark, corpus):
    docs, labels = corpus
    more = [(2000 + i, f"the garden {form} was quiet") for i, form in enumerate(HIDDEN)]
    clean = [(3000, "a well-known garden 2024 was good!"), (3001, "it is as we go - - - to a field"), (3002, "- - - ... a@b.example.com 10.5")]
    rows = {r.doc_id: r.predicted for r in toxicity.score(
        spark, docs.unionByName(spark.createDataFrame(more + clean, docs.schema)), labels).collect()}
    assert [form for i, form in enumerate(HIDDEN) if not rows[2000 + i]] == []
    assert [rows[i] for i in (3000, 3001, 3002)] == [0, 0, 0]


def test_short_pieces_of_accented_letters():
    data = np.frombuffer("a i m b é c i l e x-y word éé".encode(), np.uint8)
    start, stop, doc = toxicity.ws.word_spans(data, np.array([0, len(data)]))
    words, runs = toxicity.odd_tokens(data, start, stop, doc)
    assert words.tolist() == [9, 11] and runs.tolist() == [[0, 9]]


def test_held_out_labels_are_not_used(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic"))
                                .otherwise(toxicity.F.col("toxic")))
    key = lambda r: r.doc_id
    assert sorted(toxicity.score(spark, docs, labels).collect(), key=key) == sorted(toxicity.score(spark, docs, flipped).collect(), key=key)


def test_edges(spark, edge_docs, edge_rows, edge_labels, no_docs):
    out = toxicity.score(spark, edge_docs, edge_labels).collect()
    assert len(out) == len(edge_rows) and all(r.score is not None for r in out)
    assert len({r.score for r in out if r.doc_id == 2}) == 1
    assert not toxicity.score(spark, no_docs, edge_labels).collect()
    assert {r.score for r in toxicity.score(spark, edge_docs, edge_labels.limit(0)).collect()} == {0.0}
