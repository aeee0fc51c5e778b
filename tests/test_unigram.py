"""Unigram lattice against brute force, and training invariants."""
import itertools
import math
import random

import pytest

from quire.operators import unigram as ug


def _all_segmentations(word):
    n = len(word)
    for cuts in itertools.product([0, 1], repeat=n - 1):
        pieces, start = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                pieces.append(word[start:k])
                start = k
        pieces.append(word[start:])
        yield pieces


def test_best_path_and_marginals_vs_brute_force():
    rng = random.Random(7)
    alphabet = "abcཀཁ་"
    vocab = {c: math.log(rng.uniform(0.01, 0.2)) for c in alphabet}
    for _ in range(40):
        L = rng.randint(2, 3)
        vocab["".join(rng.choice(alphabet) for _ in range(L))] = math.log(rng.uniform(0.01, 0.3))
    prob = {p: math.exp(v) for p, v in vocab.items()}
    for _ in range(60):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7)))
        segs = [s for s in _all_segmentations(w) if all(p in vocab for p in s)]
        best = max(segs, key=lambda s: (sum(vocab[p] for p in s)))
        got = ug.best_path(w, vocab, 4, -100.0)
        assert math.isclose(sum(vocab[p] for p in got), sum(vocab[p] for p in best), abs_tol=1e-12)
        z = sum(math.exp(sum(vocab[p] for p in s)) for s in segs if max(map(len, s)) <= 4)
        want = {}
        for s in segs:
            if max(map(len, s)) > 4:
                continue
            w_s = math.exp(sum(vocab[p] for p in s)) / z
            for p in s:
                want[p] = want.get(p, 0.0) + w_s
        for use_prob in (None, prob):
            counts, ll = ug.expected_counts(w, 1.0, vocab, 4, use_prob)
            assert math.isclose(ll, math.log(z), rel_tol=1e-9)
            assert set(counts) == set(want)
            assert all(math.isclose(counts[p], want[p], rel_tol=1e-9) for p in want)


def test_pre_tokens_and_decode():
    text = "ab cd  ཀ་ཁ་། ef"
    toks = ug.pre_tokens(text)
    assert toks == ["ab", "▁cd", "▁ཀ་", "ཁ་།", "▁ef"]
    assert ug.decode_unigram(toks) == "ab cd ཀ་ཁ་། ef"


def test_train_unigram_small(spark):
    rng = random.Random(3)
    syll = ["ཀ་", "ཁ་", "ག་", "ང་", "ཅ་"]
    lines = [" ".join("".join(rng.choice(syll) for _ in range(rng.randint(1, 4))) + "།"
                      for _ in range(rng.randint(1, 6))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    v = ug.train_unigram(df, 40, seed_size=200)
    rows = v.collect()
    assert len(rows) <= 40 and [r.id for r in rows] == list(range(len(rows)))
    pieces = {r.piece for r in rows}
    assert set("".join(lines).replace(" ", "")) <= pieces | {"▁"}
    toks = ug.tokenise_unigram(df, v, bos=False, eos=False).collect()
    by_id = {r.id: r.piece for r in rows}
    for t, r in zip(lines, toks):
        assert ug.decode_unigram([by_id[i] for i in r.input_ids]) == t


def test_digamma_and_bayesian_m_step(spark):
    assert math.isclose(ug.digamma(1.0), -0.5772156649015329, rel_tol=1e-10)
    assert math.isclose(ug.digamma(0.5), -1.9635100260214235, rel_tol=1e-10)
    assert math.isclose(ug.digamma(10.0), 2.251752589066721, rel_tol=1e-10)
    lp = ug._m_step({"a": 10.0, "b": 0.5}, "digamma")
    ml = ug._m_step({"a": 10.0, "b": 0.5}, "none")
    assert lp["b"] < ml["b"]                          # rare pieces are shrunk
    df = spark.createDataFrame([("ab ab abc ཀ་ཁ་",)] * 20, "text string")
    v = ug.train_unigram(df, 12, seed_size=50, prior="digamma")
    assert v.count() <= 12


def test_arrow_pre_tokens_equal_python():
    import random

    import pyarrow as pa
    texts = ["ab cd  ཀ་ཁ་། ef", "  lead", "trail  ", "", "ཀ་ཁ་།ག", "a\tb　c\x1cd", "།།a", "ཀ་ ་ཁ", None]
    rng = random.Random(1)
    alpha = ["a", "b", " ", "  ", "་", "།", "ཀ", "\n", "　", "é"]
    texts += ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    got = ug.arrow_pre_tokens(pa.array(texts, pa.string())).to_pylist()
    assert got == [w for t in texts for w in ug.pre_tokens(t or "")]


def maximal_repeats(words):
    """Substrings of two characters or more that occur twice, by definition."""
    at = {}
    for w, f in words.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                c, left, right = at.setdefault(w[i:j], [0.0, set(), set()])
                at[w[i:j]][0] = c + f
                left.add(w[i - 1] if i else "")
                right.add(w[j] if j < len(w) else "")
    return {p: c for p, (c, left, right) in at.items()
            if c > 1 and (len(left) > 1 or "" in left) and (len(right) > 1 or "" in right)}


def test_repeated_pieces_by_definition(spark):
    """Also with prefixes so hot that they are cut several times."""
    rng = random.Random(5)
    alpha = ["a", "a", "a", "b", "é", "ཀ", "་", "\U0001F600"]
    words = {"".join(rng.choice(alpha) for _ in range(rng.randint(1, 12))): float(rng.randint(1, 5)) for _ in range(300)}
    words |= {"a" * 30: 1.0, "qu" * 9: 2.0, "qux": 1.0}
    df = spark.createDataFrame(list(words.items()), "word string, freq double").repartition(3)
    want = maximal_repeats(words)
    for limit in (10_000, 20, 3):
        chars, longer = ug.repeated_pieces(df, 40, limit)
        assert {r.piece: r.c for r in longer.collect()} == want
        assert len(longer.collect()) == len(want)
        assert {r.piece: r.c for r in chars.collect()} == {c: sum(w.count(c) * f for w, f in words.items()) for c in set("".join(words))}
    seeds = {r.piece: r.c for r in ug.seed_pieces(df, 50).collect() if len(r.piece) > 1}
    cover = sorted((c * len(p) for p, c in seeds.items()), reverse=True)
    assert len(seeds) >= 50 and cover[-1] == cover[49]  # ties are whole


def test_forward_backward_equals_the_loop(spark):
    import numpy as np
    rng = random.Random(9)
    words = ["".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 5, 9, 30, 400]))) for _ in range(60)] + ["a" * 3000]
    pieces = sorted({c for c in "abcd"} | {w[i:i + k] for w in words[:40] for i in range(0, len(w), 3) for k in (2, 3, 11)})
    logp = {p: math.log(rng.uniform(1e-6, 0.1)) for p in pieces if len(p) == 1 or rng.random() < 0.7}
    prob = np.array([0.0, *[math.exp(logp[p]) if p in logp else 0.0 for p in pieces]])
    df = spark.createDataFrame([(w, float(i % 3 + 1)) for i, w in enumerate(words)], "word string, freq double")
    rows = ug.lattices(df, pieces).collect()
    longest = max(map(len, pieces))
    for r in rows:
        n = len(r.word)
        cells = np.frombuffer(bytes(r.cells), np.int32).reshape(1, n, min(n, longest))
        want, ll = ug.expected_counts(r.word, r.freq, logp, longest)
        got, got_ll, bad = ug.forward_backward(cells, np.array([r.freq]), prob, 1.8 if n < 1000 else 0.0)
        if n >= 1000:
            assert bad.all()
            continue
        assert math.isclose(ll, got_ll, rel_tol=1e-9)
        assert all(math.isclose(got[i], want.get(p, 0.0), rel_tol=1e-9, abs_tol=1e-9) for i, p in enumerate(pieces, 1))
    bc = spark.sparkContext.broadcast
    sums = ug.lattices(df, pieces).mapInArrow(ug._e_step_fn(bc(prob), bc(pieces), 0.0), "at long, c double")
    total = {r.at: r.c for r in sums.groupBy("at").agg({"c": "sum"}).withColumnRenamed("sum(c)", "c").collect()}
    whole = [ug.expected_counts(w, float(i % 3 + 1), logp, longest) for i, w in enumerate(words)]  # underflows among them
    assert math.isclose(total[0], sum(ll for _, ll in whole), rel_tol=1e-9)
    for i, p in enumerate(pieces, 1):
        assert math.isclose(total.get(i, 0.0), sum(c.get(p, 0.0) for c, _ in whole), rel_tol=1e-9, abs_tol=1e-9)


def test_long_pieces_are_learned_and_decoded(spark):
    rng = random.Random(2)
    long = ["internationalisation", "uncharacteristically", "བསྒྲུབས་པའི་རྒྱལ་པོ"]
    texts = [" ".join(rng.choice([*long, "".join(rng.choice("abcdefg") for _ in range(5))]) for _ in range(30)) for _ in range(60)]
    texts += ["  two  spaces\t", "", None, "odd Ω"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    v = ug.train_unigram(df.where("i < 60"), 80)
    pieces = {r.piece for r in v.collect()}
    assert any(len(p) > 8 for p in pieces) and pieces & {ug.SPACE + w for w in long[:2]}
    ids = ug.tokenise_unigram(df, v).select("i", "input_ids")
    back = {r.i: r.text for r in ug.decode_unigram_table(ids, v).collect()}
    assert all(back[i] == texts[i] for i in range(60)) and back[61] == back[62] == ""
    assert back[63] == "odd <unk>" and "<unk>" in back[60]
    loose = spark.createDataFrame([(1, [0, 999, -1]), (2, None)], "i long, input_ids array<int>")
    assert [r.text for r in ug.decode_unigram_table(loose, v).orderBy("i").collect()] == ["<unk>" * 3, ""]


@pytest.mark.parametrize("prior", ["none", "digamma"])
def test_counts_that_underflow_in_a_large_total_are_no_counts(prior):
    counts = {"a": 1e9, "b": 5e-324, "ab": 3e8, "ba": 1e-316, "c": 1e-300}
    logp = ug._m_step(ug._present(counts, {"a", "b", "c"}), prior)
    assert set(logp) == {"a", "b", "c", "ab"}
    assert all(math.exp(v) > 0 or prior == "digamma" for v in logp.values())
    assert ug._present({"a": 2.0, "ab": 1e-9}, {"a", "z"}) == {"a": 2.0, "ab": 1e-9, "z": 1e-3}
