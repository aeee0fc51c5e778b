import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string, turns string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said))
    return out


def test_examples_and_edges(spark):
    rows = [(1, 0, "system", "be <|im_end|> brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "a <\\| b <<|"), (1, 3, "user", None),
            (1, 4, "assistant", ""), (2, 0, "user", "alone"), (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (3, None, None, "null turn"),
            (None, 0, "as%sis<|\ntant", "odd role"), (4, 0, "assistant", "€𝄞" * 3000)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    examples = chat.format_examples(df).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.read_back(chat.format_examples(df)).collect()}
    assert got == expected(rows)
    first = [r for r in examples if r.conv_id == 1 and r.example == 3][0]
    assert first.formatted.count(chat.START) == 3 and first.formatted.endswith(chat.END)
    body = first.formatted[first.loss_start:first.loss_start + first.loss_length]
    assert re.sub(r"<\\(\\*)\|", r"<\1|", body) == "a <\\| b <<|"
    assert sum(r.conv_id == 2 and r.loss_length == -1 for r in examples) == 1
    assert not chat.format_examples(df.limit(0)).collect()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<\\|a\n"))
def test_escape_is_reversible(text):
    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and re.sub(r"<\\(\\*)\|", r"<\1|", escaped) == text
