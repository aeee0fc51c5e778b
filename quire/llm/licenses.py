"""Licence scan: Aho-Corasick over the words of a text finds notice phrases and
identifier tags; the expression after a tag is parsed by a shunting-yard and
evaluated.

A text is lower-cased (A-Z) and its words are runs of digits, letters and other
characters from U+0080 on. Joined by single spaces they go through one automaton
of all phrases, so that a phrase is found wherever its words stand in a row,
overlapping places included. The three base phrases give ``n_base``,
``first_word``, ``last_word`` and ``base_labels``. Of the other phrases that
overlap, one within a longer one does not count.

A tag is one of TAGS with a colon or equals sign right behind it; its expression
reaches to the last token that can continue it, to the end of the line at most::

    or < and < with,   e.g.  (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0

Each identifier stands for a label (see ``known``) and for how far it restricts
use, 0 to 1. ``or`` leaves the choice, so the smaller restriction holds; ``and``
binds by both, so the larger; ``with`` names an exception, which halves it. An
expression has the labels of all its identifiers. ``score`` is the largest
restriction that any phrase or expression of the text states, 0 without any.
An expression that does not parse (a missing operand or bracket) has no labels
and counts as UNKNOWN, as does an unknown identifier; behind a tag that is a word
of prose too (PROSE) it does not count at all.

Defined cases: a null or empty text has no words, no labels and score 0; first
and last word are null without a base phrase; repeated rows get equal results;
long texts are read whole; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.llm.arrow import slices
from quire.session import ship_package

# Fixed values of the contract: phrase and label.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Other notice phrases and the identifiers they state.
NOTICES = {
    "mit license": "mit", "mit licence": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache", "apache license 2 0": "apache-2.0", "apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms": "bsd", "bsd license": "bsd",
    "gnu general public license": "gpl", "gnu gpl": "gpl",
    "gnu general public license version 2": "gpl-2.0", "gnu general public license v2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0", "gnu general public license v3": "gpl-3.0",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "mozilla public license version 2": "mpl-2.0", "eclipse public license": "epl",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "cc by 3 0": "cc-by-3.0", "cc by 4 0": "cc-by-4.0", "cc0 1 0": "cc0",
    "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution non commercial": "cc-by-nc",
    "released into the public domain": "public-domain", "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "license expression", "license", "licence")
#: Tags that are words of prose too: without a known identifier behind them they say nothing.
PROSE = TAGS[2:]
#: Families of identifiers: restriction, and whether the label names the version.
FAMILIES = {
    "public-domain": (0.0, False), "cc0": (0.0, False), "unlicense": (0.0, False), "0bsd": (0.0, False),
    "mit": (0.1, False), "isc": (0.1, False), "bsd": (0.1, False), "zlib": (0.1, False), "apache": (0.2, True),
    "cc-by": (0.2, False), "mpl": (0.4, True), "epl": (0.4, True), "lgpl": (0.5, True), "cc-by-sa": (0.6, False),
    "gpl": (0.7, True), "agpl": (0.8, True), "cc-by-nd": (0.8, False), "cc-by-nc": (0.9, False), "cc-by-nc-sa": (0.9, False),
    "cc-by-nc-nd": (0.9, False), "all-rights-reserved": (1.0, False),
}
UNKNOWN = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_notices long, n_tags long")

#: A-Z to a-z; what belongs to no word to a space.
_WORD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_TOKEN = re.compile(rb"[ \t]*([()]|[0-9a-z][0-9a-z.+-]*)")
_OPENING = re.compile(rb"[ \t]*[:=][ \t]*[\"'`]?")

Value = tuple[float, frozenset]


def known(identifier: str) -> Value:
    """Restriction and label of an identifier: its longest family, and the
    major version where the family's licences differ by it. Unknown: no label."""
    parts = identifier.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        family = "-".join(parts[:n])
        if family in FAMILIES:
            restriction, versioned = FAMILIES[family]
            version = re.match(r"v?(\d+)", parts[n]) if versioned and n < len(parts) else None
            return restriction, frozenset([f"{family}-{version[1]}" if version else family])
    return UNKNOWN, frozenset()


def tokens(line: bytes) -> Iterator[str]:
    """The tokens of an expression at the start of ``line`` (lower case). A full
    stop behind an identifier ends a sentence, and with it the expression."""
    at = 0
    while found := _TOKEN.match(line, at):
        token = found[1].decode()
        yield token.rstrip(".")
        if token.endswith("."):
            return
        at = found.end()


def postfix(stream: Iterator[str]) -> list[str] | None:
    """Shunting-yard: the tokens up to the first that cannot continue the
    expression, in postfix order; None if that is no whole expression."""
    out: list[str] = []
    held: list[str] = []
    operand, depth = True, 0  # an operand is due; open brackets
    for token in stream:
        if operand and token == "(":
            held.append(token)
            depth += 1
        elif operand and token not in PRECEDENCE and token != ")":
            out.append(token)
            operand = False
        elif not operand and token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        elif not operand and token == ")" and depth:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif operand:
            return None
        else:
            break
    if operand or depth:
        return None
    return out + held[::-1]


def evaluate(code: list[str]) -> Value | None:
    """The value of a postfix expression; None where ``with`` does not stand
    between two identifiers."""
    stack: list[tuple[float, set, str | None]] = []  # restriction, labels, the identifier itself
    for token in code:
        if token not in PRECEDENCE:
            restriction, labels = known(token)
            stack.append((restriction, set(labels), token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if left[2] is None or right[2] is None:
                return None
            exception = re.sub(r"-\d.*$", "", right[2])
            stack.append((left[0] / 2, {f"{x}-with-{exception}" for x in left[1]}, None))
        else:
            few, many = sorted((left[1], right[1]), key=len)
            many |= few
            choose = min if token == "or" else max
            stack.append((choose(left[0], right[0]), many, None))
    restriction, labels, _ = stack.pop()
    return restriction, frozenset(labels)


def expression(line: bytes) -> Value | None:
    """The value of the expression behind a tag; None if no expression begins
    there at all (no sign, or nothing like a token behind it)."""
    sign = _OPENING.match(line)
    if not sign or not _TOKEN.match(line, sign.end()):
        return None
    code = postfix(tokens(line[sign.end():]))
    value = evaluate(code) if code else None
    return value if value is not None else (UNKNOWN, frozenset())


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """All phrases between spaces, with (words, base label, notice, tag)."""
    phrases: dict[str, list] = {}
    for n, table in enumerate((BASE, NOTICES, {t: t for t in TAGS})):
        for phrase, what in table.items():
            phrases.setdefault(phrase, [len(phrase.split()), None, None, None])[n + 1] = what
    out = ahocorasick.Automaton()
    for phrase, facts in phrases.items():
        out.add_word(f" {phrase} ", (len(phrase) + 2, *facts))
    out.make_automaton()
    return out


def _outermost(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans that lie in no longer one."""
    kept: list[tuple[int, int, str]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not kept or span[1] > kept[-1][1]:
            kept.append(span)
    return kept


def scan_text(text: bytes) -> tuple:
    """The result columns of one text behind its doc_id."""
    plain = text.translate(_WORD)
    words = plain.split()
    padded = b" " + b" ".join(words) + b" "
    hits = [(end - facts[0] + 1, facts) for end, facts in automaton().iter(padded.decode("latin-1"))]
    if not hits:
        return len(words), 0, None, None, "", "", 0.0, 0, 0
    spaces = np.flatnonzero(np.frombuffer(padded, np.uint8) == 0x20)
    first = np.searchsorted(spaces, [at for at, _ in hits]).tolist()
    base, notices, tags = [], [], []
    for word, (_, (_, n, label, notice, tag)) in zip(first, hits):
        if label:
            base.append((word, label))
        if notice:
            notices.append((word, word + n, notice))
        if tag:
            tags.append((word, word + n, tag))
    base_labels = {label for _, label in base}
    values = [known(label) for label in base_labels]
    notices = _outermost(notices)
    values += [known(notice) for notice in {name for _, _, name in notices}]
    n_tags = 0
    if tags:
        inside = np.frombuffer(plain, np.uint8) != 0x20
        ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        lower = text.lower()  # bytes: A-Z only
        for _, stop, tag in _outermost(tags):
            at = int(ends[stop - 1])
            until = lower.find(b"\n", at)
            value = expression(lower[at:until if until >= 0 else len(lower)].rstrip(b"\r"))
            if value is not None and (value[1] or tag not in PROSE):
                n_tags += 1
                values.append(value)
    labels = base_labels.union(*[v[1] for v in values])
    return (len(words), len(base), min((w for w, _ in base), default=None), max((w for w, _ in base), default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), max((v[0] for v in values), default=0.0), len(notices), n_tags)


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each document, texts read whole in the tasks that scan them."""
    ship_package(spark)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [scan_text(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column("text")]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [pa.int64()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA)
