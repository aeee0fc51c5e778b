"""Quality rules with line sequence labelling.

Every line with a word gets features from its words and from its place in the
document; a linear-chain conditional random field with the states content and
boilerplate scores lines and their neighbours, and Viterbi decoding marks each
line. A document is kept when it passes the base rules and at least
CONTENT_SHARE of its word characters lie in content lines.

The field is fitted by gradient ascent on the whole texts of at most SAMPLE
labelled documents (those of smallest hash of doc_id). Labels speak of documents, so lines
of good documents are content, and the lines of bad ones are boilerplate where
their features are more frequent in bad documents than in good ones; after the
first fit the decoder marks the lines of bad documents anew and the field is
fitted once more. Without labels of both kinds every line is content.

Everything else covers the whole text of every document. Word rules: words are
runs of characters other than \\x20 and \\x09-\\x0D.

Defined cases: a null or empty text has no words and no lines and fails the
base rules; repeated rows get equal results; ties between the states go to
content; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import words as ws
from quire.llm.arrow import joined, slices
from quire.session import ship_package

SAMPLE = 4000
CONTENT_SHARE = 0.5
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LOWER, _DIGIT, _STOP, _LOUD = (np.zeros(256, bool) for _ in range(5))
_UPPER[ord("A"):ord("Z") + 1] = True
_LOWER[ord("a"):ord("z") + 1] = True
_DIGIT[ord("0"):ord("9") + 1] = True
_STOP[list(b".!?:;\"'")] = True
_LOUD[list(b"!?")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80
#: Upper edges of the bins of each measure of a line.
BINS = {
    "words": (1, 3, 7, 15, 31), "word_length": (2.5, 4, 6, 8), "symbols": (0, 0.01, 0.05, 0.15),
    "upper": (0.02, 0.2, 0.6), "digits": (0, 0.05, 0.3), "loud": (0, 0.02, 0.06), "stutter": (0, 0.1, 0.5),
    "repeats": (0, 0.3, 0.8), "stop": (0.5,), "copies": (0.5,),
}
WIDTH = 1 + sum(len(b) + 1 for b in BINS.values())


class Lines:
    """The lines with a word of a batch of texts: ``doc``, ``chars`` (code
    points of their words) and ``features`` (a column of feature numbers for
    each measure), and the base figures of each text in ``base``."""

    def __init__(self, texts: pa.Array) -> None:
        n = len(texts)
        data, offsets = joined(texts)
        start, stop, doc = ws.word_spans(data, offsets)
        sums = ws.prefix_sums(data)
        hashes = ws.spans_hash(sums, start, stop)

        def upto(mask: np.ndarray) -> np.ndarray:
            return np.concatenate((np.zeros(1, np.int64), np.cumsum(mask, dtype=np.int64)))

        lead = upto(_LEAD[data] & ~ws.IS_SPACE[data])
        symbol = upto(_SYMBOL[data])
        count = np.bincount(doc, minlength=n)
        # words of windows that a text holds twice or more
        found, place = ws.windows(hashes, doc, WINDOW)
        order = np.lexsort((found, doc[place]))
        f, o = found[order], doc[place][order]
        same = np.zeros(len(f) + 1, bool)
        same[1:-1] = (f[1:] == f[:-1]) & (o[1:] == o[:-1])
        twice = place[order[same[1:] | same[:-1]]]
        cover = np.zeros(len(start) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
        repeated = np.cumsum(cover)[:-1] > 0
        # lines: spans between line feeds, ends of texts
        feeds = np.flatnonzero(data == 10)
        begin = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
        owner = np.searchsorted(offsets[1:], begin, side="right")
        # a line after a feed that ends its text belongs to that text, not to the next; it is empty
        end = np.concatenate((begin[1:], [len(data)]))
        end = end - ((end > begin) & (data[np.maximum(end - 1, 0)] == 10) if len(data) else 0)
        line_of = np.searchsorted(begin, start, side="right") - 1
        words = np.bincount(line_of, minlength=len(begin))
        keep = np.flatnonzero(words)
        lines = ws.spans_hash(sums, begin[keep], end[keep])
        self.doc = owner[keep]
        order = np.lexsort((np.arange(len(keep)), lines, self.doc))
        same = np.zeros(len(keep) + 1, bool)
        same[1:-1] = (lines[order][1:] == lines[order][:-1]) & (self.doc[order][1:] == self.doc[order][:-1])
        later, copies = np.zeros(len(keep), bool), np.zeros(len(keep), bool)
        later[order] = same[:-1]
        copies[order] = same[1:] | same[:-1]
        stutter = np.zeros(len(start), bool)
        stutter[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])

        w = words[keep]

        def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
            s = upto(mask)
            return (s[end[keep]] - s[begin[keep]]) / np.maximum(of, 1)

        self.chars = lead[end[keep]] - lead[begin[keep]]
        by_line = lambda v: np.bincount(line_of, weights=v, minlength=len(begin))[keep]
        last = data[np.maximum(stop - 1, 0)] if len(data) else np.zeros(0, np.uint8)
        final = np.zeros(len(begin), bool)
        final[line_of] = _STOP[last]  # the last word of the line is assigned last
        letters = np.maximum(share(_UPPER[data], 1) + share(_LOWER[data], 1), 1)
        measure = {
            "words": w, "word_length": self.chars / np.maximum(w, 1), "symbols": share(_SYMBOL[data], self.chars),
            "upper": share(_UPPER[data], letters), "digits": share(_DIGIT[data], self.chars), "loud": share(_LOUD[data], self.chars),
            "stutter": by_line(stutter) / np.maximum(w, 1), "repeats": by_line(repeated) / np.maximum(w, 1),
            "stop": final[keep].astype(float), "copies": copies.astype(float),
        }
        columns, at = [np.zeros(len(keep), np.int64)], 1
        for name, edges in BINS.items():
            columns.append(at + np.searchsorted(np.array(edges, float), measure[name], side="left"))
            at += len(edges) + 1
        self.features = np.stack(columns, 1)
        ends = offsets[1:]
        self.base = {
            "n_words": count, "word_chars": lead[ends] - lead[offsets[:-1]], "n_symbols": symbol[ends] - symbol[offsets[:-1]],
            "n_dup_lines": np.bincount(self.doc[later], minlength=n),
            "n_repeat_words": np.bincount(doc[repeated], minlength=n),
        }


class Field:
    """A linear-chain conditional random field of two states (0 content, 1
    boilerplate): the score of a marking is the sum of the weights of the
    features of its lines (``lines``, for state 1) and of its steps
    (``steps``)."""

    def __init__(self, lines: np.ndarray, steps: np.ndarray) -> None:
        self.lines, self.steps = lines, steps

    def scores(self, features: np.ndarray) -> np.ndarray:
        score = np.zeros((len(features), 2))
        score[:, 1] = self.lines[features].sum(1)
        return score

    def decode(self, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Best marking of the lines of each document (``doc`` is sorted)."""
        n = len(doc)
        if not n:
            return np.zeros(0, np.int64)
        score = self.scores(features)
        back = np.zeros((n, 2), np.int64)
        first, steps = _steps(doc)
        for rows in steps:  # rows: the t-th lines of all documents that have one
            before = score[rows - 1][:, :, None] + self.steps
            back[rows] = before.argmax(1)
            score[rows] += before.max(1)
        mark = np.zeros(n, np.int64)
        last = np.concatenate((first[1:], [n])) - 1
        mark[last] = score[last].argmax(1)
        for rows in reversed(steps):
            mark[rows - 1] = back[rows, mark[rows]]
        return mark

    def fit(self, features: np.ndarray, doc: np.ndarray, mark: np.ndarray, rounds: int = 60, rate: float = 0.5) -> None:
        """Gradient ascent (Adam) on the likelihood of the marking."""
        n = len(doc)
        first, steps = _steps(doc)
        seen = np.bincount(features[mark == 1].ravel(), minlength=WIDTH).astype(float)
        pairs = np.flatnonzero(doc[1:] == doc[:-1])
        seen_steps = np.zeros((2, 2))
        np.add.at(seen_steps, (mark[pairs], mark[pairs + 1]), 1)
        m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
        for t in range(1, rounds + 1):
            score = self.scores(features)
            ahead, behind = score.copy(), np.zeros((n, 2))
            for rows in steps:
                ahead[rows] += np.logaddexp.reduce(ahead[rows - 1][:, :, None] + self.steps, 1)
            for rows in reversed(steps):
                behind[rows - 1] = np.logaddexp.reduce((score[rows] + behind[rows])[:, None, :] + self.steps, 2)
            last = np.concatenate((first[1:], [n])) - 1
            whole = np.repeat(np.logaddexp.reduce(ahead[last], 1), np.diff(np.concatenate((first, [n]))))
            likely = np.exp(ahead + behind - whole[:, None])[:, 1]
            expected = np.bincount(features.ravel(), weights=np.repeat(likely, features.shape[1]), minlength=WIDTH)
            step = np.exp(ahead[pairs][:, :, None] + self.steps + (score + behind)[pairs + 1][:, None, :]
                          - whole[pairs][:, None, None]).sum(0)
            gradient = np.concatenate((seen - expected, (seen_steps - step).ravel())) / n
            gradient -= 1e-4 * np.concatenate((self.lines, self.steps.ravel()))
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
            move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            self.lines = self.lines + move[:WIDTH]
            self.steps = self.steps + move[WIDTH:].reshape(2, 2)


def _steps(doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """First line of each document, and for t = 1, 2, ... the t-th lines."""
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    size = np.diff(np.concatenate((first, [len(doc)])))
    order = np.argsort(-size, kind="stable")
    first_by_size, size = first[order], size[order]
    longest = int(size[0])
    counts = np.searchsorted(-size, -np.arange(1, longest), side="left")
    return first, [first_by_size[:c] + t for t, c in enumerate(counts.tolist(), 1)]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """The field from at most ``sample`` labelled documents; their lines, as
    feature numbers, are all that the driver sees."""
    ship_package(docs.sparkSession)
    chosen = (labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("good").cast("int"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines = Lines(batch.column("text"))
            cuts = np.searchsorted(lines.doc, np.arange(batch.num_rows + 1))
            raw = lines.features.astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), pa.array([raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["good", "lines"])

    rows = sorted(((r.good, bytes(r.lines)) for r in texts.mapInArrow(work, "good int, lines binary").collect()))
    rows = [r for r in rows if r[1]]
    field = Field(np.zeros(WIDTH), np.zeros((2, 2)))
    field.lines[0] = -1.0
    if not {0, 1} <= {r[0] for r in rows}:
        return field
    columns = 1 + len(BINS)
    parts = [np.frombuffer(r[1], np.uint8).reshape(-1, columns).astype(np.int64) for r in rows]
    features = np.concatenate(parts)
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    good = np.repeat(np.array([r[0] for r in rows]), [len(p) for p in parts])
    in_good = np.bincount(features[good == 1].ravel(), minlength=WIDTH) + 1.0
    in_bad = np.bincount(features[good == 0].ravel(), minlength=WIDTH) + 1.0
    odds = np.log(in_bad / in_bad[0]) - np.log(in_good / in_good[0])
    mark = ((odds[features].sum(1) > 0) & (good == 0)).astype(np.int64)
    field.fit(features, doc, mark)
    mark = np.where(good == 0, field.decode(features, doc), 0)
    field.fit(features, doc, mark)
    return field


def judge(spark: SparkSession, docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """Base figures, content share and verdict of every document."""
    ship_package(spark)
    model = spark.sparkContext.broadcast(pickle.dumps((field.lines, field.steps)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Field(*pickle.loads(model.value))
        for batch in slices(batches, "text"):
            n = batch.num_rows
            lines = Lines(batch.column("text"))
            mark = crf.decode(lines.features, lines.doc)
            base = lines.base
            content = np.bincount(lines.doc, weights=lines.chars * (mark == 0), minlength=n)
            part = content / np.maximum(base["word_chars"], 1)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * base["n_words"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(base[c].astype(np.int64)) for c in
                                           ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                 pa.array(failed), pa.array(part), pa.array(~failed & (part >= share))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        work, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, content_share double, kept boolean")
