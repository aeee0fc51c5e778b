import re

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing


def filled(sizes):
    """Targets by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_sources, left = {}, set(names), sum(sizes.values())
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if weight[s] * level > 3 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_sources})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        open_sources -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 9000, "b": 10, "c": 200, "d": 7000, None: 50}, {"a": 5, "z": 100000, "ü": 300}, {"a": 0, "b": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(filled(sizes))


def test_mix_edges(spark, edge_docs, edge_rows, no_docs):
    rows = mixing.mix(spark, edge_docs).collect()
    assert len(rows) == len(edge_rows)
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    sizes = {}
    for r in edge_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    target, taken = filled(sizes), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 4 * mixing.BLOCK
    again = mixing.mix(spark, edge_docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.key, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert not mixing.mix(spark, no_docs).collect() and not mixing.mixed_texts(spark, no_docs).collect()
    texts = mixing.mixed_texts(spark, edge_docs).where("doc_id = 8").collect()
    assert sum(size(t.text) for t in texts) == sum(r.taken for r in rows if r.doc_id == 8)
    assert texts[0].asDict().keys() == set(edge_docs.columns)


def slot_by_slot(spark, docs, target):
    """Words taken of each (doc_id, key, source), one slot after the other."""
    sizes = mixing.sized(docs).withColumn("h", F.xxhash64("key")).collect()  # one bucket
    blocks, total = {}, 0  # source -> blocks of (document, words)
    for s in {r.source for r in sizes}:
        words = [r for r in sorted((r for r in sizes if r.source == s), key=lambda r: (
            r.h, (0, 0) if r.doc_id is None else (1, r.doc_id), r.key)) for _ in range(r["size"])]
        total += len(words)
        blocks[s] = [words[i:i + mixing.BLOCK] for i in range(0, len(words), mixing.BLOCK)]
    names = sorted((s for s in target if s is not None and target[s] > 0), key=lambda s: s.encode()) + [None] * (target.get(None, 0) > 0)
    ends, upto = [], 0.0
    for s in names:
        low = round(upto / sum(target.values()) * mixing.MODULUS)
        upto += target[s]
        ends.append((s, low, round(upto / sum(target.values()) * mixing.MODULUS)))
    taken, rank = {}, dict.fromkeys(names, 0)
    for slot in range(-(-total // mixing.BLOCK)):
        point = slot * mixing.STEP % mixing.MODULUS
        for s, low, high in ends:
            if low <= point < high:
                if rank[s] < mixing.MAX_PASSES * len(blocks[s]):
                    for r in blocks[s][rank[s] % len(blocks[s])]:
                        taken[r.doc_id, r.key, s] = taken.get((r.doc_id, r.key, s), 0) + 1
                rank[s] += 1
    return taken


def test_taken_words_slot_by_slot(spark, edge_docs):
    text = lambda k, n: " ".join(f"{k}w{i}" for i in range(n))
    rows = [(i, text(i, 5 + i * 7 % 190), "abc"[i * i % 3]) for i in range(120)] + [(None, text("n", 40), None)] * 9 + [(7, text(7, 54), "b")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for some in (docs, edge_docs):
        sizes = {}
        for r in mixing.sized(some).collect():
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        got = {}
        for r in mixing.mix(spark, some).collect():
            got[r.doc_id, r.key, r.source] = got.get((r.doc_id, r.key, r.source), 0) + r.taken
        want = slot_by_slot(spark, some, filled(sizes))
        assert {k: v for k, v in got.items() if v} == want


def test_cut_texts_keep_their_lines(spark):
    rows = [(i, "  " + "".join(f"w{i}x{j}" + "\n \t"[j % 3:] for j in range(70)), "ab"[i % 2]) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    whole = {i: t for i, t, _ in rows}
    out = mixing.mixed_texts(spark, docs).collect()
    cut = [r for r in out if r.text != whole[r.doc_id]]
    assert cut and all(whole[r.doc_id].startswith(r.text) and not r.text[-1].isspace() for r in cut)


def test_repeated_rows_do_not_fill_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOC_BUCKET", 20)
    rows = [(None, f"a text {i} of no id", "a") for i in range(200)] + [(1, "one row again and again", "a")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    starts = sorted((r.start, r.start + r["size"]) for r in mixing.shuffled_offsets(mixing.sized(docs), len(rows)).collect())
    assert len(starts) == 400 and starts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(starts, starts[1:]))


def test_offsets_are_worked_out_once(spark):
    """Their windows stand in a plan of their own, not twice in that of the mix."""
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, "d e", "y")], "doc_id long, text string, source string")
    plan = mixing.mix(spark, docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan
    assert "xxhash64" not in plan
