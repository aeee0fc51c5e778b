import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from quire.llm import repeats


def brute(rows, length=repeats.LENGTH):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p:p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b) + length)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        gone = gone[:len(b)]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(bool(gone[k]) and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = repeats.remove_repeats(spark, df).collect()
    for r in out:
        assert r.n_removed or r.kept.decode() == r.kept_text or r.kept_text is None
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out)


def corpus(seed, letters="abcdefghijklmnop ", texts=60):
    r = random.Random(seed)
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    shared = [make(r.randrange(190, 420)) for _ in range(12)]
    rows = []
    for i in range(texts):
        parts = [make(r.randrange(0, 300))]
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            a = r.randrange(0, 60)
            parts += [s[a:a + r.randrange(150, 420)], make(r.randrange(0, 260))]
        rows.append((i, "".join(parts)))
    for i in range(6):  # near copies
        t = list(rows[i][1])
        for _ in range(2):
            if t:
                t[r.randrange(len(t))] = "#"
        rows.append((100 + i, "".join(t)))
    rows += [(200, rows[0][1]), (201, rows[1][1] * 2), (202, make(199)), (203, make(200)), (204, None), (205, "")]
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "abcdefghijklmnop "), (2, "ab"), (3, "éßaΩ ")])
def test_brute_force(spark, seed, letters):
    rows = corpus(seed, letters)
    assert found(spark, rows) == brute(rows)


def test_periodic_texts(spark):
    rows = [(1, "ab " * 300), (2, "ab " * 70 + "tail"), (3, "x" * 900), (4, "x" * 205 + "y" + "x" * 200), (5, "x" * 201),
            (6, "For " * 120 + "end " * 90), (7, "z" * 200), (8, "lone" + "q" * 200)]
    assert found(spark, rows) == brute(rows)


def test_hot_keys_are_counted_by_string(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    rows = corpus(5)
    assert found(spark, rows) == brute(rows)


def test_runs_hold_whole_keys(monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 10)
    keys = sorted(random.Random(4).choices(range(-30, 30), k=200)) + [90] * 10
    batches = pa.table({"key": keys}).to_batches(max_chunksize=7)
    runs = [t.column("key").to_pylist() for t in repeats._whole_keys(iter(batches))]
    assert [k for run in runs for k in run] == keys and len(runs) > 8 and max(map(len, runs)) <= 2 * 10 + 7
    assert all(a[-1] < b[0] for a, b in zip(runs, runs[1:]))
    assert list(repeats._whole_keys(iter([]))) == []


def test_edges(spark, edge_docs, edge_rows, no_docs):
    out = repeats.remove_repeats(spark, edge_docs, ("lang", "size")).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out)
    assert got == brute([r[:2] for r in edge_rows])
    assert {r["size"] for r in out} == {"clash"}
    assert not repeats.remove_repeats(spark, no_docs).collect()
