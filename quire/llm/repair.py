"""Conversation structure repair by a shortest edit script, with Four-Russians
block tables.

A conversation is right when the initials of its roles are ``(s?(ua)+)?``. Rows
that are blank (no character but white space) or repeat the role and text of an
earlier row are deleted; a row whose last character is none of ``.!?`` is cut
off. Edits, in the order of the rows, and their costs: Keep 0, Rerole (to user
or assistant) 2, Delete 3, Insert (user or assistant without text) 2; a cut-off
row that stays costs 1 more. Of the cheapest scripts that with the least string
of initials (D, I, K, R) is taken.

The cost of what is left to do from a place on is a vector, one number for each
state of the pattern's automaton. Less its least number it is one of a few
dozen vectors, and a row's symbol turns one into another. The tables hold these
turns for every vector and every block of SPAN symbols, so costs run through a
conversation block by block, from its end. For the script each block is expanded
backward once for the vector at its right edge; then, from the left, the least
letter is taken that keeps to the cost left. Choosing from the left, with exact
costs to the right, is safe for ties whatever the lengths of the scripts.

A conversation may hold any share of all rows. Its rows are numbered over ranges
(see ``range_rank``) without their texts and cut into chunks of CHUNK rows. Each
chunk's symbols make a map from vector to (vector, cost), so that chunks are
worked on apart; the maps are put together from the last to the first, a row a
chunk. At last texts, with a row for each chunk in front of its rows, stream
through in order; a SHA-256 over a conversation's text is sequential by
definition, so its rows pass one task here, batch by batch and never held.

Defined cases: null roles and texts are one space; a null conv_id is a
conversation; null turns come first; rows of equal turns are ordered by the
digest of role and text; a role without a letter cannot be kept, nor one whose
first letter is none of s, u, a; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.index import range_rank
from quire.session import scratch_path, ship_package

SPAN, CHUNK = 4, 4096
WHITE = "\x20\x09\x0A\x0B\x0C\x0D"
STOPS = (".", "!", "?")
#: Symbols: class of the role's initial (s, u, a, other), 4 more if cut off; BLANK and REPEATED rows.
BLANK, REPEATED, SYMBOLS = 8, 9, 10
#: States: nothing yet, after s, after u, after a. The state that a user or assistant row leads to.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
FAR = 99

MAPS = "conv_id long, chunk long, turn long, mark binary, symbols binary, turned binary, costs array<long>"
EDGES = "conv_id long, chunk long, turn long, mark binary, symbols binary, edge int, cost long"
SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
TURNS = "conv_id long, place long, edit string, role string, text string"


def kept_state(symbol: int, state: int) -> int | None:
    """Where a kept row leads, if it may be kept."""
    kind = symbol % 4
    if kind == 0:
        return 1 if state == 0 else None
    return NEXT[state] if kind < 3 and NEXT[state] == kind + 1 else None


def closed(f: list[int]) -> list[int]:
    """Costs when rows may be inserted first."""
    f = list(f)
    for _ in range(3):
        f = [min(f[q], 2 + f[NEXT[q]]) for q in range(4)]
    return f


def edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of what may be done to a row, in the order of the letters."""
    yield "D", 3, state
    if symbol < BLANK:
        more = symbol // 4
        kept = kept_state(symbol, state)
        if kept is not None:
            yield "K", more, kept
        yield "R", 2 + more, NEXT[state]


class Tables:
    """Vectors, and what a symbol (``turn``, ``cost``) or a block of SPAN
    symbols (``block_turn``, ``block_cost``) on their left makes of them."""

    def __init__(self) -> None:
        start = closed([0, FAR, FAR, 0])
        self.vectors, seen = [start], {tuple(start): 0}
        turn, cost = [], []
        while len(turn) < len(self.vectors):
            f = self.vectors[len(turn)]
            turn.append([])
            cost.append([])
            for symbol in range(SYMBOLS):
                g = closed([min(c + f[after] for _, c, after in edits(symbol, q)) for q in range(4)])
                low = min(g)
                g = [x - low for x in g]
                if tuple(g) not in seen:
                    seen[tuple(g)] = len(self.vectors)
                    self.vectors.append(g)
                turn[-1].append(seen[tuple(g)])
                cost[-1].append(low)
        assert min(start) == 0 and len(self.vectors) < 256
        self.turn, self.cost = np.array(turn), np.array(cost)
        self.block_turn, self.block_cost = self.turn, self.cost
        for _ in range(SPAN - 1):  # one more symbol on the left
            after, so_far = self.block_turn, self.block_cost
            self.block_turn = np.concatenate([self.turn[after, x] for x in range(SYMBOLS)], axis=1)
            self.block_cost = np.concatenate([so_far + self.cost[after, x] for x in range(SYMBOLS)], axis=1)
        self.scripts: dict[tuple[int, int, int], tuple] = {}  # expanded blocks by (block, edge, state), emptied when large

    def codes(self, symbols: bytes) -> tuple[list[int], bytes]:
        """The numbers of the whole blocks, and the symbols behind them."""
        s = np.frombuffer(symbols, np.uint8)
        whole = len(s) // SPAN * SPAN
        weights = SYMBOLS ** np.arange(SPAN)[::-1]
        return (s[:whole].reshape(-1, SPAN) @ weights).tolist(), symbols[whole:]

    def over(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each vector on the right of ``symbols``: the one on the left and the cost."""
        at, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        codes, rest = self.codes(symbols)
        for symbol in rest[::-1]:
            at, total = self.turn[at, symbol], total + self.cost[at, symbol]
        for code in codes[::-1]:
            at, total = self.block_turn[at, code], total + self.block_cost[at, code]
        return at, total

    def expand(self, symbols: bytes, edge: int, state: int) -> tuple[list[tuple[int, str]], int]:
        """For each row the number of insertions before it and its letter; and
        the state after them. ``edge`` is the vector on the right."""
        at = [edge]
        for symbol in symbols[::-1]:
            at.append(int(self.turn[at[-1], symbol]))
        at.reverse()
        out = []
        for i, symbol in enumerate(symbols):
            here, after, paid = self.vectors[at[i]], self.vectors[at[i + 1]], int(self.cost[at[i + 1], symbol])
            before = 0
            while True:
                best = [(letter, then) for letter, c, then in edits(symbol, state) if here[state] + paid == c + after[then]]
                if here[state] == 2 + here[NEXT[state]]:
                    best.append(("I", NEXT[state]))
                letter, state = min(best)
                if letter != "I":
                    break
                before += 1
            out.append((before, letter))
        return out, state

    def script(self, symbols: bytes, edge: int, state: int) -> tuple[list[tuple[int, str]], int]:
        """As ``expand``, by blocks: their right edges by the tables, each
        expanded once for every edge and state."""
        codes, rest = self.codes(symbols)
        at = edge
        for symbol in rest[::-1]:
            at = int(self.turn[at, symbol])
        edges = [at]
        for code in codes[:0:-1]:
            edges.append(int(self.block_turn[edges[-1], code]))
        edges.reverse()
        out = []
        for n, (code, right) in enumerate(zip(codes, edges)):
            key = (code, right, state)
            if key not in self.scripts:
                if len(self.scripts) >= 1 << 16:
                    self.scripts.clear()
                self.scripts[key] = self.expand(symbols[n * SPAN:(n + 1) * SPAN], right, state)
            part, state = self.scripts[key]
            out += part
        part, state = self.expand(rest, edge, state)
        return out + part, state

    def ending(self, state: int) -> int:
        """How many rows are to be inserted at the end."""
        return self.vectors[0][state] // 2


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def marked(rows: DataFrame) -> DataFrame:
    """The rows without nulls in role and text, with their digest ``mark`` and
    their own ``symbol`` (repeats aside)."""
    some = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    bare = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(bare == "", BLANK).otherwise(kind + F.when(F.substring(bare, -1, 1).isin(*STOPS), 0).otherwise(4))
    mark = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return some.select("*", mark.alias("mark"), kind.alias("kind"), symbol.alias("symbol"))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """Rows of sorted partitions as tuples, with whether ``keys`` are new."""
    last = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        at = [batch.schema.names.index(k) for k in keys]
        for row in zip(*columns):
            key = tuple(row[i] for i in at)
            yield row, last is None or key != last
            last = key


def _record(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in ddl.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def chunk_maps(numbered: DataFrame, chunk: int) -> DataFrame:
    """A row for each chunk: its symbols, its map of vectors, and the first of its rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, out, first, symbols = tables(), [], None, bytearray()

        def row() -> tuple:
            turned, costs = t.over(bytes(symbols))
            return (*first, bytes(symbols), turned.astype(np.uint8).tobytes(), costs.tolist())

        for (conv, number, _, turn, mark, symbol), new in _runs(batches, ["conv_id", "chunk"]):
            if new:
                if first is not None:
                    out.append(row())
                if len(out) >= 512:
                    yield _record(out, MAPS)
                    out = []
                first, symbols = (conv, number, turn, mark), bytearray()
            symbols.append(symbol)
        if first is not None:
            out.append(row())
        yield _record(out, MAPS)

    rows = numbered.select("conv_id", F.expr(f"idx div {chunk}").alias("chunk"), "idx", "turn", "mark", "symbol")
    return (rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "idx").mapInArrow(work, MAPS))


def chunk_edges(maps: DataFrame) -> DataFrame:
    """The chunks with the vector on the right of each; ``cost`` is that of the
    rows from the chunk on, begun in the first state."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, edge, cost = [], 0, 0
        for (conv, number, turn, mark, symbols, turned, costs), new in _runs(batches, ["conv_id"]):
            if new:
                edge, cost = 0, 0
            cost += costs[edge]
            left = turned[edge]
            out.append((conv, number, turn, mark, symbols, edge, cost + tables().vectors[left][0]))
            edge = left
            if len(out) >= 512:
                yield _record(out, EDGES)
                out = []
        yield _record(out, EDGES)

    return maps.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk")).mapInArrow(work, EDGES)


class Conversation:
    """What one pass over a conversation's rows gathers; it holds a chunk's
    script and the audit, no texts."""

    def __init__(self, conv: int | None, chunk: int) -> None:
        self.conv, self.chunk, self.place, self.state = conv, chunk, 0, 0
        self.waiting: list[tuple] = []  # chunks to come: rows that are equal to a chunk's first may still belong to the one before
        self.cost, self.audit, self.made = 0, [], 0
        self.digest = hashlib.sha256()
        self.faults = [0, 0, 0]
        self.turns = [None, None, 0]  # least, last, different ones
        self.illegal, self.kind = 0, None

    def say(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(f"{chr(10) if self.made else ''}{role}:{text}".encode())
        self.made += 1
        return self.conv, self.made - 1, edit, role, text

    def insert(self, n: int) -> Iterator[tuple]:
        for _ in range(n):
            self.state = NEXT[self.state]
            self.audit.append("I")
            yield self.say("I", ROLE[self.state], "")

    def row(self, turn: int | None, role: str, text: str, kind: int) -> Iterator[tuple]:
        at = self.place % self.chunk
        if at == 0:
            number, self.symbols, edge, cost = self.waiting.pop(0)
            assert number == self.place // self.chunk
            self.cost = cost if number == 0 else self.cost
            self.script, _ = tables().script(self.symbols, edge, self.state)
        symbol, (before, letter) = self.symbols[at], self.script[at]
        if symbol >= 4:
            self.faults[0 if symbol == BLANK else 1 if symbol == REPEATED else 2] += 1
        if self.kind is not None and (self.kind, kind) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.kind = kind
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        yield from self.insert(before)
        self.audit.append(letter)
        if letter != "D":
            self.state = kept_state(symbol, self.state) if letter == "K" else NEXT[self.state]
            yield self.say(letter, role if letter == "K" else ROLE[self.state], text)
        self.place += 1

    def end(self) -> Iterator[tuple]:
        yield from self.insert(tables().ending(self.state))

    def summary(self) -> tuple:
        low, high, n = self.turns
        return (self.conv, high - low + 1 - n if n else 0, *self.faults, self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


def _walk(batches: Iterator[pa.RecordBatch], chunk: int, turns: bool) -> Iterator[pa.RecordBatch]:
    """Summaries, or the repaired turns, of conversations in order."""
    schema = TURNS if turns else SUMMARY
    now, out, size = None, [], 0
    for (conv, turn, _, number, role, text, kind, symbols, edge, cost), new in _runs(batches, ["conv_id"]):
        if new:
            if now is not None:
                made = list(now.end())
                out += made if turns else [now.summary()]
            now = Conversation(conv, chunk)
        if number is not None:
            now.waiting.append((number, symbols, edge, cost))
            continue
        for said in now.row(turn, role, text, kind):
            if turns:
                out.append(said)
                size += len(said[4])
        if len(out) >= 1024 or size > 1 << 20:
            yield _record(out, schema)
            out, size = [], 0
    if now is not None:
        made = list(now.end())
        out += made if turns else [now.summary()]
    yield _record(out, schema)


def _repaired(spark: SparkSession, rows: DataFrame, chunk: int, turns: bool) -> DataFrame:
    ship_package(spark)
    said = marked(rows)
    ranked = range_rank(said.select("conv_id", "turn", "mark", "symbol"), ["conv_id"], ["turn", "mark"])
    # whoever says it first: joined by a row's own number, so that no common text is one key
    first = ranked.groupBy("conv_id", "mark").agg(F.min("idx").alias("at")).select(F.col("conv_id").alias("of"), "at")
    numbered = ranked.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("idx") == F.col("at")), "left").select(
        "conv_id", "turn", "mark", "idx",
        F.when(F.col("at").isNull() & (F.col("symbol") != BLANK), REPEATED).otherwise(F.col("symbol")).cast("int").alias("symbol"))
    path = scratch_path(spark, "repair-chunks")
    chunk_edges(chunk_maps(numbered, chunk)).write.parquet(path)
    chunks = spark.read.parquet(path)
    none = lambda kind: F.lit(None).cast(kind)
    both = said.select("conv_id", "turn", "mark", none("long").alias("chunk"), "role", "text", "kind", none("binary").alias("symbols"),
                       none("int").alias("edge"), none("long").alias("cost")).unionByName(
        chunks.select("conv_id", "turn", "mark", "chunk", none("string").alias("role"), none("string").alias("text"),
                      none("int").alias("kind"), "symbols", "edge", "cost"))
    order = ["conv_id", "turn", "mark", F.asc_nulls_last("chunk")]  # chunks come before the rows
    return (both.repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(lambda batches: _walk(batches, chunk, turns), TURNS if turns else SUMMARY))


def repair(spark: SparkSession, rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each conversation of ``rows`` (conv_id, turn, role, text): its
    faults, the cost and letters of the edits and the digest of what they make:
    ``role:text`` of each turn, joined by newlines."""
    return _repaired(spark, rows, chunk, turns=False)


def repaired_turns(spark: SparkSession, rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The turns after repair, in place, with the letter of the edit that made them."""
    return _repaired(spark, rows, chunk, turns=True)


def damage(rows: DataFrame) -> DataFrame:
    """Test damage, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1
    empties its text, 2 removes its full stops, 3 repeats it, 4 makes it a user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("__hit")).where("__hit != 0")
    return hit.select(
        "conv_id", "turn", F.when(F.col("__hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__hit") == 1, "").when(F.col("__hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("__hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


def repair_damaged(spark: SparkSession, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The repair of damaged conversations; those without a row left have no
    faults, edits or text."""
    done = repair(spark, damage(conversations), chunk).withColumnRenamed("conv_id", "of")
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    joined = every.join(done, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
