"""Work space of the Arrow batch maps follows a slice of the batch, not all of it."""

import pyarrow as pa
import pytest

from quire.functions.batches import slices
from quire.operators import tokenise as tk
from quire.operators import unigram as ug


class Held:
    def __init__(self, value):
        self.value = value


def _texts(n=600, size=20_000):
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([("ab \U0001F600 " * size)[:size]] * n, pa.string())], ["doc_id", "text"])


VOCAB = (["<unk>", "<s>", "</s>", "ab"], [0, 1, 2, 3])
FUNCTIONS = {
    "codepoint": lambda: tk._cp_encode_fn("text", ["doc_id"], tk.CP_BOS, tk.CP_EOS),
    "word": lambda: tk._word_map_fn(Held(VOCAB), "text", ["doc_id"], 0, 1, 2),
    "unigram": lambda: ug._tokenise_fn(Held(({"a": -1.0, "b": -2.0}, {"a": 3, "b": 4}, 0, -12.0)), "text", ["doc_id"], 1, 1, 2),
}


@pytest.mark.parametrize("name", FUNCTIONS)
def test_tokenisers_give_out_slices_with_the_rows_of_the_whole(name):
    batch = _texts(150)
    parts = list(FUNCTIONS[name]()(iter([batch])))
    assert len(parts) > 1 and max(p.num_rows for p in parts) < 100
    one = [list(FUNCTIONS[name]()(iter([batch.slice(k, 1)])))[0] for k in (0, 149)]
    whole = pa.Table.from_batches(parts)
    assert whole["doc_id"].to_pylist() == list(range(150))
    for k, row in zip((0, 149), one):
        assert whole["input_ids"][k].as_py() == row["input_ids"][0].as_py()


@pytest.mark.parametrize("fn", [lambda: tk._cp_decode_fn("input_ids", ["doc_id"], "text", []),
                                lambda: tk._decode_word_fn(Held(pa.array(VOCAB[0])), "input_ids", ["doc_id"], " ", set())])
def test_decoders_give_out_slices(fn):
    ids = pa.array([[3, 0, 3] * 3_000] * 100 + [None, []], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(102)), ids], ["doc_id", "input_ids"])
    parts = list(fn()(iter([batch])))
    assert len(parts) > 1
    whole = pa.Table.from_batches(parts)
    assert whole["doc_id"].to_pylist() == list(range(102))
    assert whole["text"][7].as_py() == list(fn()(iter([batch.slice(7, 1)])))[0]["text"][0].as_py()


def test_slices_cover_every_row_once_and_hold_one_row_at_least():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "", "y" * 3, "z"])], ["text"])
    cut = [b.column("text").to_pylist() for b in slices(iter([batch, batch.slice(0, 0), batch.slice(3)]), "text", 4)]
    assert cut == [["x" * 10], [None, "", "y" * 3, "z"], ["y" * 3, "z"]]
