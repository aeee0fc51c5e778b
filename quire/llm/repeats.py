"""Removal of repeated passages by prefix-free parsing and suffix arrays.

A byte goes when it lies in a string of LENGTH bytes that starts anywhere else
too, in the same text or in another one.

Parsing: a rolling hash of WINDOW bytes marks a trigger where it is smaller than
its RADIUS neighbours on either side. Triggers depend on the bytes around them
alone, so equal strings are cut alike and every start of a string of LENGTH
bytes is named by the first trigger RADIUS bytes or more after it: it is a
suffix of at most LEFT bytes of the phrase that ends there (dictionary side) and
LENGTH less that many bytes from there on (parse side). A phrase occurrence
stands for all its starts at once; its key is the hash of the KEY bytes after
the trigger, which all equal strings share.

Pruning: occurrences whose key is the only one of its kind hold no repeated
string. Occurrences with equal key and equal context are one entry of the
dictionary; an entry met twice is repeated as a whole, whatever the size of the
group, and only keys with several different entries go on.

Suffix arrays: these entries are dealt out by key and worked on in runs of whole
keys, so that a task holds few at a time. The reversed left parts of the entries
of a run are sorted (suffix array of the dictionary), and so are
the right parts (suffix array of the parse), each with the lengths of common
prefixes between neighbours. A string with l bytes on the left is repeated if
and only if another entry has the same class at depth l on the left and at depth
LENGTH - l on the right. Entries of keys with more than HOT entries are split:
each of their strings is counted by its own hash, in partial sums.

Starts without a trigger in reach (periodic text) are counted by the hash of
their string as well, repeats within a text before they leave the task.

Rows are told apart by a 64-bit hash of doc_id and text, strings by 64-bit
hashes of key and context together (128 bits), those out of a trigger's reach by
one 64-bit hash.

Defined cases: a null text is empty; texts shorter than LENGTH stay whole; the
bytes left may hold parts of characters, which ``kept_text`` drops;
repeated rows are texts of their own, so from LENGTH bytes on they go wholly; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import words as ws
from quire.llm.arrow import joined, slices
from quire.session import ensure_checkpoint_dir, frees_shuffles, scratch_path, ship_package

LENGTH, WINDOW, RADIUS, KEY = 200, 8, 24, 64
LEFT = LENGTH - KEY
HOT = 20_000
ROW = "key long, context long, row long, first long, left_size int, starts int"
NAMES = [x.split()[0] for x in ROW.split(", ")]


def _least_ahead(v: np.ndarray, k: int) -> np.ndarray:
    """Least of v[i .. i + k - 1] at each i (short at the end)."""
    out, width = v.copy(), 1
    while width < k:
        step = min(width, k - width)
        wider = out.copy()
        wider[:-step] = np.minimum(out[:-step], out[step:])
        out, width = wider, width + step
    return out


def triggers(sums: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of the triggers."""
    n = len(sums) - 1
    if n < 2 * RADIUS + WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    v = ws.spans_hash(sums, np.arange(n - WINDOW + 1), np.arange(WINDOW, n + 1))
    ahead = _least_ahead(v, RADIUS)
    before, after = np.zeros(len(v), np.uint64), np.zeros(len(v), np.uint64)
    before[RADIUS:] = ahead[:-RADIUS]
    after[:-RADIUS] = ahead[1:len(v) - RADIUS + 1]
    place = np.flatnonzero((v < before) & (v < after))
    text = np.searchsorted(offsets, place, side="right") - 1
    inside = (place - RADIUS >= offsets[text]) & (place + RADIUS + WINDOW <= offsets[text + 1])
    return place[inside], text[inside]


def row_ids(ids: pa.Array, sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    numbers = np.asarray(ids.fill_null(0).cast(pa.int64())).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        return ws.mix(ws.spans_hash(sums, offsets[:-1], offsets[1:]) + ws.mix(numbers + ws.BASE)).view(np.int64)


def occurrences(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The phrase occurrences of a batch; ``first`` is the first start (in
    bytes of its text), ``left_size`` the bytes from there to the trigger,
    ``starts`` the number of starts."""
    data, offsets = joined(texts)
    sums = ws.prefix_sums(data)
    rows = row_ids(ids, sums, offsets)
    place, text = triggers(sums, offsets)
    begin, end = offsets[text], offsets[text + 1]
    previous = np.full(len(place), -LENGTH * 4, np.int64)
    if len(place):
        same = text[1:] == text[:-1]
        previous[1:][same] = place[:-1][same]
    low = np.maximum(RADIUS, place + LENGTH - end)
    high = np.minimum(np.minimum(LEFT, place - np.where(previous < 0, begin - LENGTH * 4, previous) + RADIUS - 1), place - begin)
    some = low <= high
    place, text, low, high, begin = place[some], text[some], low[some], high[some], begin[some]
    key = ws.spans_hash(sums, place, place + KEY)
    with np.errstate(over="ignore"):
        context = ws.mix(ws.spans_hash(sums, place - high, place - low + LENGTH) + high.astype(np.uint64))
    # starts out of reach of a trigger
    free = np.zeros(len(data) + 1, np.int64)
    size = np.diff(offsets)
    long = np.flatnonzero(size >= LENGTH)
    np.add.at(free, offsets[long], 1)
    np.add.at(free, offsets[long] + size[long] - LENGTH + 1, -1)
    np.add.at(free, place - high, -1)
    np.add.at(free, place - low + 1, 1)
    loose = np.flatnonzero(np.cumsum(free) > 0)
    of = np.searchsorted(offsets, loose, side="right") - 1
    h = ws.spans_hash(sums, loose, loose + LENGTH)
    order = np.lexsort((loose, h, of))
    same = np.zeros(len(loose) + 1, bool)
    same[1:-1] = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
    one = order[~same[:-1]]  # the first of each string of a text
    again = np.sort(order[same[1:] | same[:-1]])  # strings that the text itself repeats
    at, of_again = loose[again], of[again]
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (of_again[1:] != of_again[:-1])
    heads = np.flatnonzero(cut)
    length = np.diff(np.concatenate((heads, [len(at)])))
    twice = np.repeat(heads, 2)  # a run counts as met twice
    with np.errstate(over="ignore"):
        run_key = ws.mix(rows[of_again[twice]].view(np.uint64) + ws.mix(at[twice].astype(np.uint64) + ws.BASE))
    owner = np.concatenate((text, of[one], of_again[twice]))
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate((key, h[one], run_key)).view(np.int64)),
        pa.array(np.concatenate((context, h[one], run_key)).view(np.int64)),
        pa.array(rows[owner]),
        pa.array(np.concatenate((place - high, loose[one], at[twice])) - offsets[owner]),
        pa.array(np.concatenate((high, np.zeros(len(one) + len(twice), np.int64))).astype(np.int32)),
        pa.array(np.concatenate((high - low + 1, np.ones(len(one), np.int64), np.repeat(length, 2))).astype(np.int32))], NAMES)


def parse(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield occurrences(batch.column("doc_id"), batch.column("text"))

    return docs.mapInArrow(work, ROW)


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with row, the number that tells its rows apart."""
    kept = [c for c in docs.columns if c != "row"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = joined(batch.column("text"))
            rows = row_ids(batch.column("doc_id"), ws.prefix_sums(data), offsets)
            yield pa.RecordBatch.from_arrays([pa.array(rows), *[batch.column(c) for c in kept]], ["row", *kept])

    kinds = dict(docs.dtypes)
    return docs.select(*kept).mapInArrow(work, ", ".join(["row long", *[f"`{c}` {kinds[c]}" for c in kept]]))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the entries of each text."""
    for batch in slices(batches, "text"):
        out: list[tuple] = []
        for row, text, entries in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(),
                                      batch.column("entries").to_pylist()):
            raw = text.encode()
            for e in entries:
                trigger = e["first"] + e["left_size"]
                out.append((e["key"], e["n"], e["hot"], row, e["first"], e["starts"], raw[e["first"]:trigger],
                            raw[trigger:e["first"] + e["starts"] - 1 + LENGTH]))
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 8, kinds)],
                                         ["key", "n", "hot", "row", "first", "starts", "left", "right"])


CONTEXT = "key long, n long, hot boolean, row long, first long, starts int, left binary, right binary"


def _sorted_with_lcp(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each part in the suffix array, length of the common prefix
    with the part before it in that order)."""
    table = np.array(parts, dtype=f"S{width}")
    order = np.argsort(table, kind="stable")
    letters = table[order].view(np.uint8).reshape(-1, width)
    common = np.zeros(len(parts), np.int64)
    for at in range(1, len(parts), 1 << 14):
        to = min(at + (1 << 14), len(parts))
        differ = letters[at:to] != letters[at - 1:to - 1]
        common[at:to] = np.where(differ.any(1), differ.argmax(1), width)
    place = np.empty(len(parts), np.int64)
    place[order] = np.arange(len(parts))
    return place, common


def repeated_starts(lefts: list[bytes], rights: list[bytes], starts: np.ndarray) -> np.ndarray:
    """Whether the string at each start is repeated among the entries: a row for
    each entry, column i for its i-th start."""
    n = len(lefts)
    size = np.fromiter(map(len, lefts), np.int64, n)
    left_place, left_common = _sorted_with_lcp([x[::-1] for x in lefts], LEFT)
    right_place, right_common = _sorted_with_lcp(rights, LENGTH)
    found = np.zeros((n, int(starts.max(initial=0))), bool)
    for depth in range(0, LEFT + 1):  # strings with this many bytes on the left
        number = size - depth
        some = np.flatnonzero((number >= 0) & (number < starts))
        if not len(some):
            continue
        left_class = np.cumsum(left_common < depth)[left_place[some]]
        right_class = np.cumsum(right_common < LENGTH - depth)[right_place[some]]
        _, which, count = np.unique(left_class * (n + 1) + right_class, return_inverse=True, return_counts=True)
        hit = some[count[which] > 1]
        found[hit, number[hit]] = True
    return found


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of HOT entries or more, fewer than twice as many and a batch, that
    hold all entries of their keys; the batches are sorted by key and no key has
    more than HOT."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > HOT:
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if last:
                yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _examined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_keys(batches):
        yield from _repeated_once(table)


def _repeated_once(table: pa.Table) -> Iterator[pa.RecordBatch]:
    lefts, rights = table.column("left").to_pylist(), table.column("right").to_pylist()
    found = repeated_starts(lefts, rights, table.column("starts").to_numpy())
    once = table.column("n").to_numpy() == 1  # the others are known to be repeated
    rows, first = table.column("row").to_numpy(), table.column("first").to_numpy()
    entry, number = np.nonzero(found & once[:, None])
    yield from _runs(rows[entry], first[entry] + number)


def _runs(rows: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spans covered by strings that begin at consecutive starts."""
    if len(rows):
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.concatenate((heads[1:], [len(rows)])) - 1
        yield pa.RecordBatch.from_arrays([pa.array(rows[heads]), pa.array(starts[heads]), pa.array(starts[tails] + LENGTH)],
                                         ["row", "start", "stop"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of the entries of hot keys, by its hash."""
    for batch in batches:
        lefts, rights = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        data, offsets = joined(pa.array([a + b for a, b in zip(lefts, rights)], pa.binary()))
        starts = batch.column("starts").to_numpy().astype(np.int64)
        entry = np.repeat(np.arange(batch.num_rows), starts)
        number = np.arange(len(entry)) - np.repeat(np.cumsum(starts) - starts, starts)
        at = offsets[entry] + number
        sums = ws.prefix_sums(data)
        h = ws.spans_hash(sums, at, at + LENGTH).view(np.int64)
        rows, first = batch.column("row").to_numpy(), batch.column("first").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column("key").to_numpy()[entry]), pa.array(h), pa.array(rows[entry]), pa.array(first[entry] + number),
             pa.array(batch.column("n").to_numpy()[entry])], ["key", "string", "row", "start", "n"])


def covers(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(row, start, stop): the spans of repeated strings, overlapping."""
    path = scratch_path(spark, "phrases")
    found = parse(docs)
    shared = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found.join(shared, "key").write.parquet(path)
    kept = spark.read.schema(ROW).parquet(path)
    entries_path = scratch_path(spark, "entries")
    at = F.struct("row", "first", "left_size", "starts")
    kept.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(at).alias("at")).write.parquet(entries_path)
    entries = spark.read.parquet(entries_path)
    whole = kept.join(entries.where("n > 1").select("key", "context"), ["key", "context"]).select(
        "row", F.col("first").alias("start"), (F.col("first") + F.col("starts") - 1 + LENGTH).alias("stop"))
    several = entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    asked = entries.join(several, "key").select("key", "n", (F.col("m") > HOT).alias("hot"), "at.*")
    by_text = asked.groupBy("row").agg(F.collect_list(F.struct("key", "n", "hot", "first", "left_size", "starts")).alias("entries"))
    texts = with_rows(docs).select("row", "text")
    contexts_path = scratch_path(spark, "contexts")
    texts.join(by_text, "row").mapInArrow(_contexts, CONTEXT).write.parquet(contexts_path)
    contexts = spark.read.schema(CONTEXT).parquet(contexts_path)
    examined = (contexts.where("not hot").repartition("key").sortWithinPartitions("key").mapInArrow(_examined, "row long, start long, stop long"))
    strings = contexts.where("hot").mapInArrow(_strings, "key long, string long, row long, start long, n long")
    often = strings.groupBy("key", "string").agg(F.count("*").alias("m")).where("m > 1").select("key", "string")
    hot = strings.where("n = 1").join(often, ["key", "string"]).select("row", "start", (F.col("start") + LENGTH).alias("stop"))
    return whole.unionByName(examined).unionByName(hot)


def _cut(kept: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = (text or "").encode()
                merged: list[list[int]] = []
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], stop)
                    else:
                        merged.append([start, stop])
                edges = [0, *[x for span in merged for x in span], len(raw)]
                rest = [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
                left = b"".join(rest)
                whole = "".join(x.decode(errors="ignore") for x in rest) if merged else text
                out.append((len(raw), len(raw) - len(left), len(merged), left, whole))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], [*kept, *MADE])

    return work


MADE = ["n_bytes", "n_removed", "n_spans", "kept", "kept_text"]


@frees_shuffles
def remove_repeats(spark: SparkSession, docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns to carry, n_bytes, n_removed, n_spans, kept,
    kept_text) of every row; kept is the bytes left, kept_text the whole
    characters among them."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    kept = ["doc_id", *carry]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry)
    kinds = dict(texts.dtypes)
    spans = covers(spark, texts.select("doc_id", "text")).groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"])
    return with_rows(texts).join(spans, "row", "left").drop("row").mapInArrow(_cut(kept), schema)
