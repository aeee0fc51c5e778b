"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree are the symbols of a word; a leaf holds rank * length +
place of the pair that begins there, an inner node the smaller of its two
children, so the root names the leftmost pair of lowest rank. A merge changes
three leaves, whose paths to the root are mended; the word is done when the
root names no pair. Words of up to WIDE symbols are merged many at a time, a
numpy row for each; longer ones alone.

The vocabulary is a file of the ``tokenizers`` library (BPE with an end-of-word
suffix), read on the driver and broadcast; its size does not depend on the
data.

Defined cases: a null text is empty; an empty text has no ids and decodes to
the empty text; the strings of special tokens within a text are those tokens,
as in the library; texts of any length are encoded whole; repeated rows are
encoded alike; other columns of the input are kept unless named like an output.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quire.llm.arrow import slices
from quire.session import ship_package

SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACES = regex.compile(f"[{SPACE}]+")
#: The pre-tokenizer's pattern, white space spelt out.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
WIDE = 64
NONE = np.int64(1) << 60
#: Distinct words that a task remembers.
REMEMBERED = 100_000


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    def __init__(self, spec: bytes) -> None:
        spec = json.loads(spec)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        chars = byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {}
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"]
            self.special[t["content"]] = t["id"]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    # words -------------------------------------------------------------

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE for one without a merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def symbols(self, word: bytes) -> np.ndarray:
        ids = self.inner[np.frombuffer(word, np.uint8)]
        ids[-1] = self.final[word[-1]]
        return ids

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_width.setdefault(max(1, (len(w) - 1).bit_length()), []).append(i)
        for bits, members in by_width.items():
            if 1 << bits > WIDE:
                for i in members:
                    out[i] = self.merged_alone(self.symbols(words[i]))
            else:
                for at in range(0, len(members), 1 << 14):
                    some = members[at:at + (1 << 14)]
                    for i, ids in zip(some, self.merged_together([words[i] for i in some], 1 << bits)):
                        out[i] = ids
        return out

    def merged_together(self, words: list[bytes], width: int) -> list[bytes]:
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        sym = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width + 1) < sizes[:, None]
        sym[inside] = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        rows = np.arange(n)
        sym[rows, sizes - 1] = self.final[np.fromiter((w[-1] for w in words), np.int64, n)]
        place = np.arange(width, dtype=np.int64)
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self.ranks_of(sym[:, :-1], sym[:, 1:])
        tree[:, width:] = np.where(rank < NONE, rank * width + place, NONE)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half
        following = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        rows = rows[tree[:, 1] < NONE]
        while len(rows):
            root = tree[rows, 1]
            at = root % width
            gone = following[rows, at]
            after = following[rows, gone]
            sym[rows, at] = self.made[root // width]
            sym[rows, gone] = -1
            following[rows, at] = after
            before[rows, after] = at
            previous = before[rows, at]
            first = previous < 0
            for leaf, a, b, dead in ((gone, None, None, None), (at, at, after, None),
                                     (np.maximum(previous, 0), np.maximum(previous, 0), at, first)):
                if a is None:
                    value = np.full(len(rows), NONE)
                else:
                    found = self.ranks_of(sym[rows, a], sym[rows, b])
                    value = np.where(found < NONE, found * width + leaf, NONE)
                    if dead is not None:
                        value = np.where(dead, tree[rows, width + leaf], value)
                node = leaf + width
                tree[rows, node] = value
                while width > 1 and node[0] > 1:
                    node = node >> 1
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] < NONE]
        left = sym[:, :width] >= 0
        ids = sym[:, :width][left].astype("<u4").tobytes()
        ends = np.cumsum(left.sum(1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merged_alone(self, ids: np.ndarray) -> bytes:
        sym = ids.tolist()
        n = len(sym)
        width = 1 << (n - 1).bit_length()
        rank_of, made, none = self.rank_of, self.made, 1 << 60
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = rank_of.get(sym[i] << 32 | sym[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        following, before = list(range(1, n + 1)), list(range(-1, n))

        def put(leaf: int, value: int) -> None:
            node = leaf + width
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        def pair(i: int, j: int) -> int:
            rank = rank_of.get(sym[i] << 32 | sym[j])
            return none if rank is None else rank * width + i

        while tree[1] < none:
            at = tree[1] % width
            gone = following[at]
            after = following[gone]
            sym[at] = int(made[tree[1] // width])
            sym[gone] = -1
            following[at] = after
            put(gone, none)
            put(at, pair(at, after) if after < n else none)
            if after < n:
                before[after] = at
            if before[at] >= 0:
                put(before[at], pair(before[at], at))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    # texts -------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = SPACES.sub(" ", text)
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return PIECES.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut: list[list] = []
        for text in texts:
            parts: list = []
            for i, part in enumerate(self.cut.split(text)):
                if i % 2:
                    parts.append(self.special[part].to_bytes(4, "little"))
                elif part:
                    parts.append(self.pieces(part))
            cut.append(parts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list({w for parts in cut for p in parts if isinstance(p, list) for w in p if w not in known})
        known.update(zip(new, self.merged([w.encode() for w in new])))
        find = known.__getitem__
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(find, p)) for p in parts]) for parts in cut]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def _codec(spec: bytes) -> Codec:
    return Codec(spec)


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, text: str = "text",
           decoded: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids (binary: little-endian unsigned 32-bit
    integers) and, if asked for, decoded: the text that the ids stand for."""
    ship_package(spark)
    with open(vocabulary or default_vocabulary(), "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())
    made = ["n_tokens", "ids", *["decoded"] * decoded]
    kept = [c for c in docs.columns if c not in made]
    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "n_tokens long, ids binary", *["decoded string"] * decoded])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in slices(batches, text):
            ids = codec.encode([t or "" for t in batch.column(text).to_pylist()])
            columns = [batch.column(c) for c in kept]
            columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([codec.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *made])

    return docs.select(*kept).mapInArrow(work, schema)
