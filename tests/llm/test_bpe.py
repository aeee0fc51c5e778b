import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from quire.llm import bpe  # noqa: E402


@pytest.fixture(scope="module")
def codec():
    with open(bpe.default_vocabulary(), "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def same(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:60]
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_like_the_library(codec, library):
    random.seed(3)
    letters = "abcdeéèÉ'stßÄ 0123\t\n\x1c\x85  ΣσςİıΩ中文字🙂éﬁ½Ⅷ_-#$%<|>ａ‍\u0000"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 90))) for _ in range(1500)]
    texts += ["", "   ", "<|endoftext|>x<|startoftext|><|endoftext|> y", "<|endoftext", "don't WE'LL I've"]
    same(codec, library, texts)


def test_long_words_take_the_single_tree(codec, library):
    random.seed(4)
    same(codec, library, ["a" * 3000, "ab" * 1500 + "c", "".join(random.choice("etaoinshr") for _ in range(3000)),
                          "x" * bpe.WIDE, "y" * (bpe.WIDE + 1), "th" * 40])


def test_memory_of_words_is_bounded(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for _ in range(3):
        same(codec, library, ["one two three four five six seven", "eight nine ten one two"])


def test_edges(spark, edge_docs, edge_rows, no_docs, library):
    rows = bpe.encode(spark, edge_docs).collect()
    assert len(rows) == len(edge_rows) and rows[0].size == "clash"
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want) and np.frombuffer(r.ids, "<u4").tolist() == want
    assert not bpe.encode(spark, no_docs).collect()
