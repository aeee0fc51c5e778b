import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import minhash


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    group = {i: i for i, _ in sets if i is not None}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return sorted((str(i), len(s), str(i if i is None else root(i))) for i, s in sets)


def found(spark, rows, n, percent=80):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = minhash.near_duplicates(spark, df, n, percent).collect()
    assert all(r.kept == (r.component_id == r.doc_id) for r in out)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out)


def family(seed, copies, size=60, edits=3):
    r = random.Random(seed)
    base = [f"w{r.randrange(400)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(copies):
        text = list(base if r.random() < 0.5 else out[r.randrange(len(out))].split())
        for _ in range(r.randrange(edits + 1)):
            text[r.randrange(len(text))] = f"e{r.randrange(1000)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("n", [4, 5])
def test_brute_force(spark, n):
    texts = [t for s in range(12) for t in family(s, 12)]
    texts += ["", None, " \n", "one", "ONE", "two words", "Two  words", "two words more", "two words more x"]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    assert found(spark, rows, n) == brute(rows, n, 80)


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = list(enumerate(family(99, 60, size=40, edits=4)))
    assert found(spark, rows, 4) == brute(rows, 4, 80)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    out = minhash.near_duplicates(spark, edge_docs, 5).collect()
    got = {}
    for r in out:
        got.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert len(out) == len(edge_rows)
    assert got[1] == {(1, True)} and got[2] == {(1, False)} and got[3] == {(3, True)} and got[None] == {(None, True)}
    assert got[7] == {(1, False)} and got[5] == {(5, True)}
    assert not minhash.near_duplicates(spark, no_docs).collect()


def test_every_coordinate_fills_and_estimates():
    for size in (1, 2, 17, 400):
        a = " ".join(f"a{i}" for i in range(size))
        owner, h = minhash.shingle_sets(pa.array([a]), 1)
        assert (minhash.sketches(owner, h, 1) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    a = " ".join(f"a{i}" for i in range(900))
    b = " ".join(f"a{i}" for i in range(100, 1000))
    owner, h = minhash.shingle_sets(pa.array([a, b]), 1)
    s = minhash.sketches(owner, h, 2)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.15


def test_components(spark):
    edges = [(5, 3), (3, 1), (9, 8), (8, 7), (7, 6), *[(i, i + 1) for i in range(20, 60)]]
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {3: 1, 5: 1, 7: 6, 8: 6, 9: 6, **{i: 20 for i in range(21, 61)}}


def test_a_pair_is_met_in_its_first_bucket_only():
    """By whole keys: other bands may agree in any part of their keys."""
    low = np.arange(minhash.BANDS, dtype=np.int64)
    one, two = low + (7 << 40), low + (9 << 40)  # all bands agree in their low 16 bits
    two[[5, 20]] = one[[5, 20]]
    fine = np.zeros(minhash.FINE, "<u2").tobytes()
    met = []
    for band in range(minhash.BANDS):
        table = pa.table({"node": [1, 2], "component": [1, 2], "n": [50, 50], "side": [2, 2], "band": [band, band],
                          "keys": [one.astype("<i8").tobytes(), two.astype("<i8").tobytes()], "fine": [fine, fine]})
        met += [band] * minhash._apart(80)((0,), table).num_rows
    assert met == [5]


def test_links_of_all_edited_copies(spark):
    """Copies with ever more words replaced: every link of the definition is found."""
    rng = np.random.default_rng(4)
    rows = []
    for base in range(40):
        words = [f"w{x}" for x in rng.integers(0, 10 ** 6, 150)]
        rows.append((1000 * base, " ".join(words)))
        for k in range(12):
            copy = list(words)
            for at in rng.choice(150, size=k // 2, replace=False):
                copy[at] = f"x{rng.integers(0, 10 ** 6)}"
            rows.append((1000 * base + k + 1, " ".join(copy)))
    want = {int(i): int(c) for i, _, c in brute(rows, 4, 80)}
    out = minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in out} == want and len(set(want.values())) < len(rows) / 2
