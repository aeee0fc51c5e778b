"""Toxicity scores of deobfuscated text.

A noisy channel turns words into leetspeak, repeats their letters and spreads
them over spaces or separators. Tokens that look so become lattices: a slot for
each run of a character, with the letters it may stand for and their costs; a
Viterbi search finds the likeliest letters under a character language model
(4-grams with Witten-Bell interpolation) counted over the words of all
documents. The restored words, beside the plain ones, are then scored.

The scorer is a list of rules, each a word or the beginning of a word with the
share of toxic documents among those that hold it. Rules are learned on at
most SAMPLE labelled documents (those of smallest hash of doc_id), one after
the other: the next is the one that covers most of the toxic documents, each of
which counts a quarter as much after every rule that it meets; of equal ones the
smallest hash. Candidates are the 50 * RULES words and beginnings that most toxic
documents of the sample hold (of equal counts the smallest hash). Documents that
are copies of one another count once. The score is the largest share
among the rules that a text meets, or the rate of the rest where it meets none.

Sizes: the language model has SYMBOLS^4 numbers and the rules are at most
RULES, whatever the input; both are broadcast.

Defined cases: a null text is empty; an empty text meets no rule; texts of any
length are read whole; repeated rows get equal scores; an empty table gives an
empty result; without labels of both kinds there are no rules and every score
is the rate of toxic labels (0 without labels). Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import words as ws
from quire.llm.arrow import joined, slices
from quire.session import ensure_checkpoint_dir, frees_shuffles, scratch_path, ship_package

SAMPLE, RULES = 10_000, 400
#: A rule needs so many toxic documents, and this lower bound of its share.
SUPPORT, LEAST_SHARE = 6, 0.6
THRESHOLD = 0.3
PREFIXES = tuple(range(4, 13))

#: What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
MASK, VOWELS, SEPARATORS = "*#", "aeiou", ".-_~"

#: Character classes of the model: 0 no letter, 1-26 a-z, 27 any other letter.
SYMBOLS = 28
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a"):ord("z") + 1] = _CLASS[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CLASS[0xC0:] = 27
_LETTER = _CLASS > 0
_LETTER[0x80:0xC0] = True
_DIGIT, _SIGN, _INNER = (np.zeros(256, bool) for _ in range(3))
_DIGIT[list(b"0123456789")] = True
_SIGN[list(b"@$!|+(*#")] = True
_INNER[list(b".-_~*")] = True
_PIECE = _DIGIT | _LETTER | _SIGN | _INNER


def count_characters(docs: DataFrame) -> DataFrame:
    """(gram, n): 4-grams of character classes over the words of all texts,
    counted in every task before they are summed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 4, np.int64)
        for batch in slices(batches, "text"):
            data, offsets = joined(batch.column("text"))
            c = np.insert(_CLASS[data], offsets[:-1], 0)
            c = c[np.insert((data < 0x80) | (data >= 0xC0), offsets[:-1], True)]
            c = np.concatenate((np.zeros(3, np.int64), c, np.zeros(1, np.int64)))
            one = c[2:-1]
            two = np.where(one == 0, 0, c[1:-2])
            three = np.where(two == 0, 0, c[:-3])
            now = c[3:]
            some = (now > 0) | (one > 0)
            gram = ((three * SYMBOLS + two) * SYMBOLS + one) * SYMBOLS + now
            total += np.bincount(gram[some], minlength=SYMBOLS ** 4)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["gram", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of the last class of each 4-gram given the first three."""
    counts = np.zeros(SYMBOLS ** 4)
    for gram, n in count_characters(docs).collect():  # SYMBOLS^4 rows at most
        counts[gram] = n
    counts = counts.reshape((SYMBOLS,) * 4)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(4):
        c = counts.sum(axis=tuple(range(3 - order)))
        total, kinds = c.sum(-1, keepdims=True), (c > 0).sum(-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).astype(np.float32).ravel()


class Channel:
    """Restores tokens; the answers for distinct tokens are remembered."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    @staticmethod
    def slots(token: str) -> list[list[tuple[str, float]]]:
        """The lattice of a token; " " between the letters marks spaces."""
        out: list[list[tuple[str, float]]] = []
        runs = [len(list(same)) for ch, same in groupby(token) if ch.isalpha()]
        doubled = sum(n == 2 for n in runs)
        all_doubled = doubled >= 2 and 2 * doubled >= len(runs)  # the channel doubles letters, words seldom do
        at = 0
        while at < len(token):
            ch = token[at]
            n = 1
            while at + n < len(token) and token[at + n] == ch:
                n += 1
            at += n
            if ch.isalpha():
                out.append([(ch, 0.0)] if n == 1 else [(ch * 2, 0.0), (ch, -1.5)] if n == 2 and not all_doubled else [(ch, -0.5), (ch * 2, -0.5)])
            elif ch in LEET:
                options = [(c, -1.0) for c in LEET[ch]]
                out.append(options if n == 1 else options + [(c * 2, -1.0) for c in LEET[ch]])
            elif ch in MASK:
                out.append([(v, -2.0) for v in VOWELS] + [("", -2.5)])
            elif ch == " " or ch in SEPARATORS:
                out.append([("", -0.4), (" ", -1.0)])
            else:
                out.append([(" ", 0.0)])
        return out

    def decode(self, slots: list[list[tuple[str, float]]]) -> str:
        model, size = self.model, SYMBOLS
        best: dict[int, tuple] = {0: (0.0, ())}  # state: the last three classes; text as (text before, letters)
        for options in slots:
            after: dict[int, tuple] = {}
            for state, (score, text) in best.items():
                for letters, cost in options:
                    s, p = state, score + cost
                    for ch in letters:
                        c = ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch != " " else 0
                        if c or s:
                            p += model[s * size + c]
                        s = (s * size + c) % (size ** 3) if c else 0
                    if s not in after or p > after[s][0]:
                        after[s] = (p, (text, letters))
            best = after
        text = max(((p + (model[s * size] if s else 0.0), text) for s, (p, text) in best.items()), key=lambda x: x[0])[1]
        out = []
        while text:
            text, letters = text
            out.append(letters)
        return "".join(reversed(out))

    def restore(self, token: str) -> str:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 50_000:
                self.known = {}
            found = self.decode(self.slots(token))
            if len(token) <= 100:  # long runs hardly come again
                self.known[token] = found
        return found


def odd_tokens(data: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words that a lattice may read in another way, spans of short pieces):
    indices of words that hold a letter, digit or sign and besides a sign or
    digit, a separator inside, or a doubled letter, and (first, last + 1) of runs
    of at least three words of one or two characters, two of them no separators."""
    def ahead(flags: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.int64), np.cumsum(flags)))

    def holds(sums: np.ndarray) -> np.ndarray:
        return sums[stop] - sums[start]

    n = len(data)
    letter, sign, digit = _LETTER[data], _SIGN[data], _DIGIT[data]
    double = np.zeros(n, bool)
    double[1:] = (data[1:] == data[:-1]) & letter[1:] & letter[:-1] & (data[1:] < 0x80)
    for size in (2, 3, 4):  # characters of more bytes
        head = (data >= (0, 0, 0xC0, 0xE0, 0xF0)[size]) & (data < (0, 0, 0xE0, 0xF0, 0xF8)[size])
        head[:size] = False
        for k in range(size):
            head[size:n - k] &= data[size + k:] == data[k:n - size]
        double |= head
    solid = letter | digit | sign
    first = np.flatnonzero(solid) if n else np.zeros(0, np.int64)
    inner = np.zeros(n, bool)  # a separator with something before and after it
    if len(start) and len(first):
        word = np.repeat(np.arange(len(start)), stop - start)
        place = np.concatenate([np.zeros(0, np.int64), np.arange(len(word)) - np.repeat(np.cumsum(stop - start) - (stop - start), stop - start) + start[word]])
        sums = ahead(solid)
        inner[place] = _INNER[data[place]] & (sums[place] > sums[start[word]]) & (sums[stop[word]] > sums[place + 1])
    some = holds(ahead(letter | digit)) > 0
    odd = (holds(ahead(sign | double | inner)) > 0) | ((holds(ahead(digit)) > 0) & (holds(ahead(letter | sign)) > 0))
    words = np.flatnonzero(some & odd)
    if not len(start):
        return words, np.zeros((0, 2), np.int64)
    points = holds(ahead((data < 0x80) | (data >= 0xC0)))
    short = (points <= 2) & (holds(ahead(_PIECE[data])) == stop - start)
    new = np.ones(len(start), bool)
    new[1:] = ~(short[1:] & short[:-1] & (doc[1:] == doc[:-1]))
    heads = np.flatnonzero(new)
    size = np.diff(np.concatenate((heads, [len(start)])))
    full = np.add.reduceat((holds(ahead(solid)) > 0).astype(np.int64), heads)
    runs = (size >= 3) & short[heads] & (full >= 2)
    return words, np.stack((heads[runs], heads[runs] + size[runs]), 1)


def restored_words(texts: pa.Array, channel: Channel) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, stop, doc) of the plain words in lower case, without
    marks at their ends, and after them the restored words."""
    data, offsets = joined(pc.utf8_lower(texts))
    start, stop, doc = ws.word_spans(data, offsets)
    odd, runs = odd_tokens(data, start, stop, doc)
    more: list[bytes] = []
    owner: list[int] = []
    raw = data.tobytes()
    for i in odd.tolist():
        token = raw[start[i]:stop[i]].decode().strip(".,;:?\"'()[]%&")
        for word in channel.restore(token).split():
            more.append(word.encode())
            owner.append(doc[i])
    for a, b in runs.tolist():
        token = " ".join(raw[start[i]:stop[i]].decode() for i in range(a, b))
        for word in channel.restore(token).split():
            more.append(word.encode())
            owner.append(doc[a])
    # plain words end at their outermost letters or digits
    solid = _LETTER[data] | _DIGIT[data]
    place = np.arange(len(data))
    nearest = np.minimum.accumulate(np.where(solid, place, len(data))[::-1])[::-1]
    furthest = np.maximum.accumulate(np.where(solid, place, -1))
    if len(start):
        first, last = nearest[start], furthest[stop - 1] + 1
        real = first < last
        start, stop, doc = first[real], last[real], doc[real]
    size = np.fromiter(map(len, more), np.int64, len(more))
    ends = np.cumsum(size) + len(data)
    data = np.concatenate((data, np.frombuffer(b"".join(more), np.uint8)))
    return (data, np.concatenate((start, ends - size)), np.concatenate((stop, ends)),
            np.concatenate((doc, np.array(owner, np.int64))))


def word_features(data: np.ndarray, start: np.ndarray, stop: np.ndarray, sums: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of the word): whole words for kind 0, else the first
    ``kind`` bytes of longer words."""
    some = np.flatnonzero(stop - start > kind)
    end = start[some] + kind if kind else stop[some]
    with np.errstate(over="ignore"):
        return ws.mix(ws.spans_hash(sums, start[some], end) + np.uint64(kind) * ws.BASE).view(np.int64), some


@lru_cache(1)
def _channel(model: bytes) -> Channel:
    return Channel(np.frombuffer(model, np.float32))


def labelled_features(docs: DataFrame, model) -> DataFrame:
    """(toxic, copy, features) of each text; ``copy`` is alike for near copies."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = _channel(model.value)
        for batch in slices(batches, "text"):
            data, start, stop, doc = restored_words(batch.column("text"), channel)
            sums = ws.prefix_sums(data)
            hashes, owner = [], []
            copy = np.full(batch.num_rows, np.iinfo(np.int64).max)
            for kind in (0, *PREFIXES):
                h, word = word_features(data, start, stop, sums, kind)
                hashes.append(h)
                owner.append(doc[word])
                if kind == 0:  # the least hash of three words in a row
                    three, place = ws.windows(h.view(np.uint64), owner[0], 3)
                    short = np.bincount(owner[0], minlength=batch.num_rows)[owner[0]] < 3
                    np.minimum.at(copy, owner[0][short], h[short])
                    np.minimum.at(copy, owner[0][place], three.view(np.int64))
            found, of = np.concatenate(hashes), np.concatenate(owner)
            order = np.lexsort((found, of))
            found, of = found[order], of[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
            found, of = found[new], of[new]
            ends = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(copy), pa.ListArray.from_arrays(pa.array(ends), pa.array(found))],
                ["doc_id", "toxic", "copy", "features"])

    return docs.select("doc_id", "toxic", F.col("text").cast("string")).mapInArrow(
        work, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int, copy long, features array<long>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _lower_bound(k: np.ndarray, n: np.ndarray, z: float = 1.64) -> np.ndarray:
    """Wilson's lower bound of a share."""
    n = np.maximum(n, 1)
    p = k / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def learn_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame, model) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, shares, rate of the rest) from the labelled documents that
    are not held out."""
    chosen = (labels.where("toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    path = scratch_path(spark, "toxic-features")
    labelled_features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), model).write.parquet(path)
    rows = spark.read.parquet(path)
    # near copies count once: the first document of each
    rows = rows.join(rows.groupBy("copy", "toxic").agg(F.min("doc_id").alias("doc_id")), ["copy", "toxic", "doc_id"], "left_semi")
    rows = rows.dropDuplicates(["doc_id"])
    truth = dict(rows.select("doc_id", "toxic").collect())  # SAMPLE rows at most
    none = np.zeros(0, np.int64)
    total = sum(truth.values())
    if not 0 < total < len(truth):
        return none, none.astype(float), total / max(len(truth), 1)
    flat = rows.select("doc_id", "toxic", F.explode("features").alias("feature"))
    useful = (flat.groupBy("feature").agg(F.sum("toxic").alias("k"), F.count("*").alias("n"))
              .where((F.col("k") >= SUPPORT) & (F.col("k") >= 0.5 * F.col("n")))
              .orderBy(F.desc("k"), "feature").limit(50 * RULES))
    pairs = flat.join(F.broadcast(useful.select("feature")), "feature").select("feature", "doc_id").collect()
    if not pairs:
        return none, none.astype(float), total / len(truth)
    ids = {d: i for i, d in enumerate(sorted(truth))}
    toxic = np.array([truth[d] for d in ids], float)
    names, feature = np.unique(np.array([p[0] for p in pairs], np.int64), return_inverse=True)
    doc = np.array([ids[p[1]] for p in pairs])
    weight = np.ones(len(ids))  # quartered by every rule that a document meets
    k = np.bincount(feature, weights=toxic[doc], minlength=len(names))
    n = np.bincount(feature, minlength=len(names))
    bound = np.where(k >= SUPPORT, _lower_bound(k, n), 0)
    picked, shares = [], []
    while len(picked) < RULES:
        left = np.bincount(feature, weights=(toxic * weight)[doc], minlength=len(names))
        new = _lower_bound(left, left + n - k)  # what it adds must hold by itself
        gain = np.where((bound >= LEAST_SHARE) & (new >= LEAST_SHARE) & (left >= SUPPORT / 2), left * new, 0)
        gain[picked] = 0
        best = int(gain.argmax())
        if not gain[best]:
            break
        picked.append(best)
        shares.append(float(bound[best]))
        weight[doc[feature == best]] *= 0.25
    open_docs = weight == 1
    rest = toxic[open_docs].sum() / max(open_docs.sum(), 1)
    return names[picked], np.array(shares), float(min(rest, 0.2))


@frees_shuffles
def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns of ``docs`` and ``score``, of every document."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    texts = docs.select("doc_id", F.col("text").cast("string"))
    model = spark.sparkContext.broadcast(character_model(texts).tobytes())
    names, shares, rest = learn_rules(spark, texts, labels.select("doc_id", "toxic"), model)
    return apply_rules(spark, docs, kept, model, names, shares, rest)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return scored(spark, docs, labels, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def apply_rules(spark: SparkSession, docs: DataFrame, kept: list[str], model, names: np.ndarray, shares: np.ndarray,
                rest: float) -> DataFrame:
    """``kept`` columns of ``docs`` and ``score``."""
    order = np.argsort(names)
    rules = spark.sparkContext.broadcast(pickle.dumps((names[order], shares[order], rest)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = _channel(model.value)
        known, share, low = pickle.loads(rules.value)
        for batch in slices(batches, "text"):
            value = np.full(batch.num_rows, low)
            if len(known):
                data, start, stop, doc = restored_words(batch.column("text"), channel)
                sums = ws.prefix_sums(data)
                met = []
                for kind in (0, *PREFIXES):
                    h, word = word_features(data, start, stop, sums, kind)
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit = known[at] == h
                    met.append(doc[word[hit]] * len(known) + at[hit])
                met = np.unique(np.concatenate(met))
                np.maximum.at(value, met // len(known), share[met % len(known)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(value)], [*kept, "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "score double"])
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(work, schema)
