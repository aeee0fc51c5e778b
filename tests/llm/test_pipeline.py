import hashlib
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quire.llm import mixing, repeats, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return [df.toPandas() for df in out]


def test_columns_and_registration(steps):
    assert all(list(df.columns) == corpus_pipeline.COLUMNS for df in steps[:-1])
    queries = entry.queries()
    assert "pipeline" in queries and all(any(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11))


def test_near_duplicates_stage(steps):
    from test_minhash import brute
    before, after = steps[1], steps[2]
    kept = {i for i, _, c in brute(list(zip(before.doc_id, before.text)), 5, 80) if i == c}
    assert set(map(str, after.doc_id)) == kept and len(after) == len(kept)


def left_texts(docs):
    """The texts without repeated strings by definition; characters that are cut apart go."""
    raw = {i: t.encode() for i, t in zip(docs.doc_id, docs.text)}
    count = Counter(b[p:p + repeats.LENGTH] for b in raw.values() for p in range(len(b) - repeats.LENGTH + 1))
    out = {}
    for i, b in raw.items():
        pieces, at = [], 0
        for p in range(len(b) - repeats.LENGTH + 1):
            if count[b[p:p + repeats.LENGTH]] > 1:
                if p > at:
                    pieces.append(b[at:p])
                at = p + repeats.LENGTH
        out[i] = "".join(x.decode(errors="ignore") for x in [*pieces, b[at:]])
    return out


def test_toxicity_stage(spark):
    """At sf0.01, as sf0.001 has too few toxic labels for a rule."""
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    low = {r.doc_id for r in toxicity.score(spark, docs, labels).where("predicted = 0").collect()}
    after = corpus_pipeline.drop_toxic(spark, docs, folder).collect()
    assert {r.doc_id: r.text for r in after} == {i: texts[i] for i in low} and len(after) == len(low)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    share = lambda kind: np.mean([i in low for i in texts if truth.get(i) == kind])
    assert share(0) >= 0.97 and share(1) <= 0.5


def test_stages_on_edge_rows(spark, edge_docs, edge_rows, no_docs):
    """Null and repeated ids, empty and long texts, clashing names, no rows: defined results of each stage."""
    for docs in (edge_docs, no_docs):
        rows = len(edge_rows) if docs is edge_docs else 0
        safe = corpus_pipeline.drop_toxic(spark, docs, SF)
        assert safe.columns == corpus_pipeline.COLUMNS and safe.count() == rows  # nothing in them is toxic
        apart = corpus_pipeline.drop_near_duplicates(spark, safe, SF)
        left = sorted((r.text is None, r.text or "", str(r.doc_id)) for r in apart.collect())
        assert apart.columns == corpus_pipeline.COLUMNS and len(left) == (rows and 13)  # two copies of the first text and the one with a tail go
        cut = corpus_pipeline.drop_repeated_passages(spark, apart, SF)
        assert cut.columns == corpus_pipeline.COLUMNS and cut.count() == len(left)
        mixed = corpus_pipeline.mix_sources(spark, cut, SF)
        assert mixed.columns == corpus_pipeline.COLUMNS and all(r.text.split() for r in mixed.collect())
        done = corpus_pipeline.encode(spark, docs, SF).collect()
        assert len(done) == rows and all(4 * r.n_tokens == len(r.ids) for r in done)
        assert all((r.n_tokens == 0) == (not (t or "").split()) for r, t in [(r, dict((x[0], x[1]) for x in edge_rows)[r.doc_id])
                   for r in done if r.doc_id in (3, 4, 5, 6, 7)])


def test_repeated_passages_stage(steps):
    from test_repeats import brute
    before, after = steps[2], steps[3]
    assert dict(zip(after.doc_id, after.text)) == left_texts(before)
    want = {i: h for i, _, _, _, h in brute(list(zip(before.doc_id, before.text)))}
    whole = {str(i): hashlib.sha256(t.encode()).hexdigest() for i, t in zip(after.doc_id, after.text)}
    assert set(want) == set(whole) and sum(want[i] == h for i, h in whole.items()) >= 0.95 * len(want)  # characters cut apart
    assert (after.n_chars == after.text.map(len)).all()


def test_mixing_and_encoding_stages(steps):
    from tokenizers import Tokenizer
    from quire.llm.bpe import default_vocabulary
    before, mixed, encoded = steps[3:]
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    whole, taken = sum(map(size, before.text)), sum(map(size, mixed.text))
    assert abs(taken - whole) <= 0.05 * whole and mixed.groupby("doc_id").size().max() <= 3
    texts = dict(zip(before.doc_id, before.text))
    words = lambda t: re.findall(mixing.WORD, t)
    assert all(words(texts[i])[:size(t)] == words(t) for i, t in zip(mixed.doc_id, mixed.text))
    library = Tokenizer.from_file(default_vocabulary())
    want = sorted(library.encode(t, add_special_tokens=False).ids for t in mixed.text)
    assert sorted(np.frombuffer(x, "<u4").tolist() for x in encoded.ids) == want


def test_run_is_the_stages(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == len(steps[-1])


def test_rows_of_one_id_are_judged_by_themselves(spark):
    word = lambda k, n=40: " ".join(f"{k}w{i}" for i in range(n))
    rows = [(1, word("a"), "en", "s", 1), (2, word("b"), "en", "s", 1), (2, word("c"), "en", "s", 1), (2, word("a"), "en", "t", 1),
            (3, word("d") + " end", "en", "s", 1), (3, word("e"), "en", "s", 1), (4, word("d"), "en", "s", 1),
            (None, word("f"), "en", "s", 1), (None, word("f"), "en", "s", 1), (None, word("g"), "en", None, 1), (None, word("a"), "en", "s", 1),
            (5, None, None, None, None), (6, "", "en", "s", 0), (7, word("h"), "en", "s", 1), (7, word("h"), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    texts = sorted((r.text or "") for r in out)
    assert texts == sorted(["", "", word("a"), word("b"), word("c"), word("d"), word("e"), word("f"), word("g"), word("h")])
    assert [r.doc_id for r in out if r.text == word("a")] == [1] and [r.doc_id for r in out if r.text == word("d")] == [4]
    assert not corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).collect()


def test_mixed_rows_take_what_the_mix_plans(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(90))
    rows = [(1, text("a"), "en", "s", 1), (1, text("a"), "en", "t", 1), (1, text("a"), "en", "t", 2), (None, text("b"), "en", None, 3)]
    rows += [(i, text(f"c{i}"), "de", "st"[i % 2], i) for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    plan = {}
    for r in mixing.mix(spark, docs).collect():
        plan[r.doc_id, r.source] = plan.get((r.doc_id, r.source), 0) + r.taken
    got = dict.fromkeys(plan, 0)
    for r in mixing.mixed_texts(spark, docs).collect():
        got[r.doc_id, r.source] += len(r.text.split())
    assert got == plan and sum(plan.values()) > 2000


def test_encoding_goes_both_ways(spark, steps):
    """The stage decodes as op5 does: the tokens of the ids, and what op5 gives for the same texts."""
    import json

    from quire.llm import bpe
    mixed, encoded = steps[4:]
    with open(bpe.default_vocabulary(), "rb") as f:
        name = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    assert all(x == " ".join(name[i] for i in np.frombuffer(ids, "<u4").tolist())
               for ids, x in zip(encoded.ids, encoded.decoded) if "<|" not in x)
    docs = spark.createDataFrame(list(enumerate(mixed.text)), "doc_id long, text string")
    assert sorted(encoded.decoded) == sorted(r.decoded for r in bpe.encode(spark, docs).collect()) and any(encoded.decoded)
