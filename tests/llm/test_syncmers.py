import hashlib
import random

import numpy as np
import pytest

from quire.llm import syncmers


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = {}
    for r in syncmers.fingerprints(edge_docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == len(edge_rows)
    assert rows[1][0].fingerprint == rows[2][0].fingerprint == rows[2][1].fingerprint
    assert rows[3][0].fingerprint == "" and rows[3][0].n_chars == 0
    assert rows[2][1].near_next in (0.0, 1.0)
    texts = {r[0]: r[1] or "" for r in edge_rows}
    t, following = texts[9], texts[8]
    edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
    assert rows[9][0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert not syncmers.fingerprints(no_docs).collect()
    one = syncmers.fingerprints(edge_docs.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_next_over_ranges(spark):
    ids = [-7, 0, 1, 5, 900, 901, 5000, *range(20_000, 20_060), 100_000, 100_001, 10**15]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    old = syncmers.BUCKET, syncmers.CELLS
    syncmers.BUCKET, syncmers.CELLS = 2, 4
    try:
        got = {r.doc_id: r.next_text for r in syncmers.with_next(df, ["text"]).collect()}
    finally:
        syncmers.BUCKET, syncmers.CELLS = old
    down = sorted(ids, reverse=True)
    assert got == {i: f"text {j}" for i, j in zip(down, down[1:] + down[:1])}


def test_anchors_do_not_depend_on_context():
    shared = " ".join(f"w{i * i % 101}" for i in range(40))
    (p, h), (q, g) = syncmers.anchors([f"some head words {shared}", f"{shared} tail"])
    at = dict(zip(h.tolist(), p.tolist()))
    inside = [(x, y) for x, y in zip(g.tolist(), q.tolist()) if y + syncmers.K_CHARS <= len(shared)]
    assert len(inside) > 5 and all(at[x] - y == 16 for x, y in inside if g.tolist().count(x) == h.tolist().count(x) == 1)


def brute_anchors(h, text, k, s):
    """Chosen windows by the definition, from the hashes ``h`` of strings of s characters."""
    out = []
    for i in range(len(text) - k + 1):
        inner = [h[text[j:j + s]] for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, text[i:i + k]))
    return out


def hash_of(text):
    return int(syncmers.string_hashes(np.array([ord(c) for c in text], np.uint32), np.zeros(1, int), np.array([len(text)]))[0])


@pytest.mark.parametrize("step", [7, 100, 1 << 20])
def test_anchors_by_definition(step, monkeypatch):
    """Also in pieces, of texts side by side."""
    monkeypatch.setattr(syncmers, "STEP", step)
    r = random.Random(2)
    texts = ["".join(r.choice("ab c我é😀") for _ in range(n)) for n in (300, 24, 25, 23, 0, 1, 60)] + ["ab" * 90]
    k, s = syncmers.K_CHARS, syncmers.S_CHARS
    h = {p: hash_of(p) for t in texts for i in range(len(t) - s + 1) for p in [t[i:i + s]]}
    for t, (pos, hashes) in zip(texts, syncmers.anchors(texts)):
        want = brute_anchors(h, t, k, s) if len(t) >= k else [(0, t)] if t else []
        assert [(p, x) for p, x in zip(pos.tolist(), hashes.tolist())] == [(p, hash_of(w)) for p, w in want]
    assert len(syncmers.anchors(texts)[0][0]) > 20


def plain(texts):
    return {i: syncmers.as_text(*syncmers.anchors([t])[0]) for i, t in texts.items()}


def test_all_anchors_and_shared_passages_at_other_places(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    long, shared = " ".join(word() for _ in range(3000)), " ".join(word() for _ in range(60))
    chinese = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(400))
    texts = {1: long, 2: " ".join(word() for _ in range(2000)) + " " + shared, 3: long[:9000] + " " + shared + " " + long[9000:],
             10: chinese[:200] + "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(200)), 11: chinese}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {x.doc_id: x for x in syncmers.fingerprints(df).collect()}
    assert len(rows[3].fingerprint) // 24 > 1000 and int(rows[3].fingerprint[-24:-16], 16) > 20_000
    assert 0.003 < rows[3].near_next < 0.05  # sixty words of thousands, elsewhere
    assert rows[2].near_next == 0
    assert 0.2 < rows[11].near_next < 0.5
    edited = {i: t[:len(t) - len(t) // 2] + texts[j][:len(t) // 2] for (i, t), j in zip(sorted(texts.items(), reverse=True), [10, 3, 2, 1, 11])}
    assert {i: x.edited_fingerprint for i, x in rows.items()} == plain(edited)
    assert all(0.2 < rows[i].near_edited < 0.6 for i in (1, 3, 11))


def test_short_edited_texts(spark):
    texts = {i: "abcdefghijklmnopqrstuvwxyz0123456789"[:i] for i in (1, 2, 7, 22, 23, 24, 25, 30, 36)}
    rows = {x.doc_id: x for x in syncmers.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    ids = sorted(texts, reverse=True)
    edited = {i: texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[j][:len(texts[i]) // 2] for i, j in zip(ids, ids[1:] + ids[:1])}
    assert {i: x.edited_fingerprint for i, x in rows.items()} == plain(edited)


def brute_likeness(a, b):
    """Pairs by the k-th place of each hash, matched where the offset is shared."""
    places = [{}, {}]
    for side, anchors in enumerate((a, b)):
        for pos, h in sorted(anchors):
            places[side].setdefault(h, []).append(pos)
    offsets = [y - x for h in places[0] for x, y in zip(places[0][h], places[1].get(h, []))]
    alone = min(len(a), len(b)) == 1
    m = sum(alone or offsets.count(o) > 1 for o in offsets)
    most = sum(min(len(p), len(places[1].get(h, []))) for h, p in places[0].items())
    assert m <= most
    return 1.0 if not a and not b else m / (len(a) + len(b) - m)


def test_likeness_by_definition_where_passages_repeat():
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    passage = " ".join(word() for _ in range(30))
    other = lambda n: " ".join(word() for _ in range(n))
    texts = [" ".join(passage for _ in range(6)), " ".join(passage + " " + other(5) for _ in range(6)), "ab " * 500, "ab " * 300 + other(20),
             passage, other(30), "", "x", "x", "abcdefghijklmnopqrstuvwxyz" * 2]
    found = syncmers.anchors(texts)
    for i, x in enumerate(found):
        for j, y in enumerate(found):
            one, two = (list(zip(p.tolist(), h.tolist())) for p, h in (x, y))
            near = syncmers.likeness(x, y)
            assert abs(near - brute_likeness(one, two)) < 1e-12 and (i != j or near == 1.0)


def test_many_null_ids_are_spread(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(60)] + [(7, "a"), (8, "b")], "doc_id long, text string")
    old = syncmers.BUCKET, syncmers.CELLS
    syncmers.BUCKET, syncmers.CELLS = 4, 2
    try:
        rows = syncmers.with_next(df, ["text"]).collect()
        tied = df.withColumn("tie", syncmers.F.xxhash64("text"))
        sizes = [x["count"] for x in tied.groupBy(syncmers.id_range(tied)).count().collect()]
    finally:
        syncmers.BUCKET, syncmers.CELLS = old
    assert max(sizes) < 20 and len(sizes) > 8
    following = {x.text: x.next_text for x in rows}
    at, seen = "b", []
    while at not in seen:
        seen.append(at)
        at = following[at]
    assert len(seen) == 62 and at == "b" and seen[1] == "a"
