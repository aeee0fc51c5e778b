"""String functions on Columns: strip, blank test, prompt rendering, answer
extraction, stop strings. All are built-in Spark expressions (codegen, no UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical prompts and
# answers; they are stated here as plain text, in their natural order.
# ---------------------------------------------------------------------------
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant. 你是一个乐于助人的助手。"
SYSTEM_FORMAT = "<|start_header_id|>system<|end_header_id|>\n\n{content}<|eot_id|>"
USER_FORMAT = ("<|start_header_id|>user<|end_header_id|>\n\n{content}<|eot_id|>"
               "<|start_header_id|>assistant<|end_header_id|>\n\n")
ASSISTANT_FORMAT = "{content}<|eot_id|>"
STOP_STRINGS = ("<|eot_id|>", "<|end_of_text|>")
ANSWER_MARKER = "assistant\n\n"
SPECIAL_MARKERS = ("<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
                   "<|end_of_text|>", "<|begin_of_text|>")

# Python's str.isspace() set (the characters str.strip() removes), written
# as a regex class body usable both by Java regex and by RE2.
PY_WHITESPACE_CLASS = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
                       r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
PY_STRIP_PATTERN = rf"\A[{PY_WHITESPACE_CLASS}]+|[{PY_WHITESPACE_CLASS}]+\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_quote(s: str) -> str:
    """Literal pattern for Java regex (Spark's split/rlike/regexp_replace)."""
    return r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E"


def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()``: removes Unicode white space at both ends."""
    return F.regexp_replace(_c(col), PY_STRIP_PATTERN, "")


def is_blank(col: Column | str) -> Column:
    return F.length(py_strip(col)) == 0


def _fill(template: str, content: Column) -> Column:
    head, tail = template.split("{content}")
    return F.concat(F.lit(head), content, F.lit(tail))


def render_prompt(col: Column | str, system: str = DEFAULT_SYSTEM_PROMPT,
                  with_prompt: bool = True) -> Column:
    """System block + user block ending with an open assistant header.
    ``with_prompt=False`` gives the input itself."""
    if not with_prompt:
        return _c(col)
    return F.concat(_fill(SYSTEM_FORMAT, F.lit(system)), _fill(USER_FORMAT, _c(col)))


def render_turn(role: Column | str, text: Column | str) -> Column:
    """One conversation turn in the chat format (system / user / assistant)."""
    role, text = _c(role), _c(text)
    return (F.when(role == "system", _fill(SYSTEM_FORMAT, text))
            .when(role == "user", _fill(USER_FORMAT, text))
            .when(role == "assistant", _fill(ASSISTANT_FORMAT, text)))


def extract_answer(col: Column | str, which: str = "second",
                   marker: str = ANSWER_MARKER) -> Column:
    """Text after the marker, stripped. ``second``: part 2 (NULL when the
    marker is missing); ``last``: the last part (whole text when missing)."""
    parts = F.split(_c(col), java_quote(marker), -1)
    if which == "second":
        part = F.try_element_at(parts, F.lit(2))
    elif which == "last":
        part = F.element_at(parts, -1)
    else:
        raise ValueError("which must be 'second' or 'last'")
    return py_strip(part)


def cut_at_stop(col: Column | str, stops: Sequence[str] = STOP_STRINGS) -> Column:
    """Text before the first occurrence of any stop string."""
    pattern = "|".join(java_quote(s) for s in stops)
    return F.element_at(F.split(_c(col), pattern, 2), 1)


def drop_markers(col: Column | str, markers: Sequence[str] = SPECIAL_MARKERS) -> Column:
    """Remove special marker strings from text (decode with special tokens skipped)."""
    pattern = "|".join(java_quote(s) for s in markers)
    return F.regexp_replace(_c(col), pattern, "")


def source_key(name: Column | str) -> Column:
    """File name without its last extension and with the dots removed:
    ``a.b.txt`` -> ``ab``; a name with no dot gives the empty string."""
    parts = F.split(_c(name), r"\.", -1)
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), "")


def url_host(col: Column | str) -> Column:
    return F.regexp_extract(_c(col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)
