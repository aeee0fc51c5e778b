import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quire.llm import linecrf

W = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = W.findall(text)
    lines = [x for x in text.split("\n") if W.search(x)]
    of = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    twice = {j for k in range(len(w) - 4) if of[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_base_figures():
    r = random.Random(2)
    texts = ["", None, "\n", "\n\na", "a\n", "a\na\n a\n", "x\r\nx\r\n"]
    texts += ["".join(r.choice("ab é|#\n\t ") for _ in range(r.randrange(200))) for _ in range(300)]
    b = linecrf.Lines(pa.array(texts, pa.string())).base
    got = list(zip(*(b[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [base(t) for t in texts]


def test_decoding_is_the_best_marking():
    r = np.random.default_rng(3)
    field = linecrf.Field(r.normal(size=linecrf.WIDTH), r.normal(size=(2, 2)))
    features = r.integers(0, linecrf.WIDTH, (23, 4))
    doc = np.sort(r.integers(0, 5, 23))
    got = field.decode(features, doc)
    score = field.scores(features)
    for d in set(doc.tolist()):
        rows = np.flatnonzero(doc == d)
        best = max(itertools.product((0, 1), repeat=len(rows)), key=lambda m: sum(score[i, s] for i, s in zip(rows, m))
                   + sum(field.steps[a, b] for a, b in zip(m, m[1:])))
        assert got[rows].tolist() == list(best)


def test_separates_boilerplate(spark):
    r = random.Random(1)
    prose = lambda: " ".join(r.choice("some plain words of a calm text about rivers and hills".split()) + str(r.randrange(99)) for _ in range(20)) + "."
    junk = lambda: " | ".join(f"Item{r.randrange(999)}" for _ in range(9)) + " |"
    docs = [(i, "\n".join((prose if i % 2 else junk)() for _ in range(6))) for i in range(200)]
    labels = [(i, i % 2) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    field = linecrf.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {x.doc_id: x.kept for x in linecrf.judge(spark, df, field).collect()}
    assert all(kept[i] == bool(i % 2) for i in range(100, 200))


def test_edges(spark, edge_docs, edge_rows, edge_labels, no_docs):
    field = linecrf.train(edge_docs, edge_labels)
    out = linecrf.judge(spark, edge_docs, field).collect()
    figures = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert sorted((str(r.doc_id), *figures(r)) for r in out) == sorted((str(r[0]), *base(r[1])) for r in edge_rows)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in out)
    assert not linecrf.judge(spark, no_docs, linecrf.train(no_docs, edge_labels)).collect()
    assert all(r.kept != r.base_failed for r in linecrf.judge(spark, edge_docs, linecrf.train(edge_docs, edge_labels.limit(0))).collect())
