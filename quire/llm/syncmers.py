"""Document fingerprints from closed syncmers.

The symbols are characters. A window of ``K_CHARS`` characters is chosen when
the smallest hash of its inner strings of ``S_CHARS`` lies at its first or last
place, which depends on the window alone: equal passages choose equal windows
wherever they stand, so the chosen windows are anchors for positional matching.
The fingerprint holds all of them in order, each as 8 hex digits of its position
and 16 of its hash.

Anchors of two texts are paired one to one: of each hash the first place in one
with the first in the other, the second with the second, and so on. A pair
matches if another pair has the same offset (difference of positions). Likeness
is the share of matched anchors among all: m / (a + b - m).

Texts meet their next one by DataFrame functions alone. Anchors and likeness are
worked out by numpy in Arrow batches: with array functions, which evaluate some
twenty lambda calls for every character, they took several times the CPU that
is allowed (README has the figures).

Defined cases: a null text is empty; a text of fewer than K_CHARS characters has
one window, all its characters, and its match counts alone; a text without
characters has the empty fingerprint, which is like another empty one by 1 and
like others by 0; null ids come last, and they and repeated doc_ids are ordered
by the hash of their texts; the next document of a single one is itself; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm import words as ws
from quire.llm.arrow import slices
from quire.operators.index import dense_index
from quire.session import ship_package

K_CHARS, S_CHARS = 24, 8
BUCKET, CELLS = 512, 32
#: Characters whose windows are worked on together.
STEP = 1 << 20

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def string_hashes(code_points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings of code points, equal for equal strings at any place."""
    sums = np.zeros(len(code_points) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(ws.mix(code_points.astype(np.uint64) + ws.BASE) * ws._power("up", ws.BASE, len(code_points)), out=sums[1:])
    return ws.spans_hash(sums, start, stop)


def _chosen(cp: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the closed syncmers among the first ``starts`` windows."""
    at = np.arange(len(cp) - S_CHARS + 1)
    m = string_hashes(cp, at, at + S_CHARS)
    places = K_CHARS - S_CHARS + 1
    low, span = m, 1
    while 2 * span <= places - 2:  # least hash of ``span`` places
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    i = np.arange(starts)
    inner = np.minimum(low[i + 1], low[i + places - 1 - span])
    found = np.flatnonzero(np.minimum(m[i], m[i + places - 1]) <= inner)
    return found, string_hashes(cp, found, found + K_CHARS)


def anchors(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of the chosen windows of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    where, hashes = [], []
    for a in range(0, len(cp) - K_CHARS + 1, STEP):
        n = min(STEP, len(cp) - K_CHARS + 1 - a)
        found, h = _chosen(cp[a:a + n + K_CHARS - 1], n)
        found = found + a
        inside = owner[found] == owner[found + K_CHARS - 1]
        where.append(found[inside])
        hashes.append(h[inside])
    short = np.flatnonzero((sizes > 0) & (sizes < K_CHARS))
    for t in short.tolist():
        part = cp[begin[t]:begin[t + 1]]
        where.append(begin[t:t + 1])
        hashes.append(string_hashes(part, np.zeros(1, np.int64), np.array([len(part)])))
    at = np.concatenate(where) if where else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(at, kind="stable")
    at, h = at[order], h[order]
    cuts = np.searchsorted(at, begin)
    return [(at[a:b] - start, h[a:b]) for a, b, start in zip(cuts[:-1], cuts[1:], begin)]


def as_text(pos: np.ndarray, hashes: np.ndarray) -> str:
    out = np.empty(len(pos), np.dtype([("pos", ">u4"), ("hash", ">u8")]))
    out["pos"], out["hash"] = pos, hashes
    return out.tobytes().hex()


def _numbered(pos: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of the place among those of the hash, position)."""
    order = np.lexsort((pos, hashes))
    h, at = hashes[order], np.arange(len(order))
    first = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    return h, at - np.maximum.accumulate(np.where(first, at, 0)), pos[order]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The share of the anchors of two texts that match at consistent offsets."""
    na, nb = len(a[0]), len(b[0])
    if not na or not nb:
        return float(na == nb)
    (ha, ka, pa_), (hb, kb, pb) = _numbered(*a), _numbered(*b)
    h, k, p = np.concatenate((ha, hb)), np.concatenate((ka, kb)), np.concatenate((pa_, pb))
    order = np.lexsort((np.arange(len(h)) >= na, k, h))
    h, k, p = h[order], k[order], p[order]
    pairs = np.flatnonzero((h[1:] == h[:-1]) & (k[1:] == k[:-1]))
    _, counts = np.unique(p[pairs + 1] - p[pairs], return_counts=True)
    matched = int(counts.sum() if min(na, nb) == 1 else counts[counts > 1].sum())
    return matched / (na + nb - matched)


def id_range(docs: DataFrame) -> Column:
    """A number that grows with doc_id and is shared by about BUCKET documents:
    CELLS^2 cells between approximate quantiles of the ids, each cut into equal
    parts. However ids are spread, a part has at most one cell's documents."""
    probes = [i / CELLS ** 2 for i in range(CELLS ** 2)]
    cuts, high, n, known = docs.agg(F.percentile_approx("doc_id", probes, 20 * CELLS ** 2), F.max("doc_id"), F.count("*"),
                                    F.count("doc_id")).first()
    # null ids come after all others, in parts of their own by the order of ties
    of_nulls = -1 - F.floor((F.col("tie").cast("double") / 2.0 ** 64 + 0.5) * ((n - known) // BUCKET + 1)).cast("long")
    if not cuts:
        return of_nulls
    ends = [*cuts[1:], high]
    parts = max(1, n // CELLS ** 2 // BUCKET + 1)
    groups = [cuts[i:i + CELLS] for i in range(0, len(cuts), CELLS)]
    upto = lambda values: F.size(F.filter(values, lambda x: x <= F.col("doc_id"))) - 1
    array = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    group = F.greatest(upto(array([g[0] for g in groups])), F.lit(0))
    cell = group * CELLS + F.greatest(upto(F.get(F.array(*map(array, groups)), group)), F.lit(0))
    low = F.get(array(cuts), cell)
    width = F.get(array([max(1, -(-(b - a) // parts)) for a, b in zip(cuts, ends)]), cell)
    part = F.floor((F.col("doc_id").cast("double") - low) / width)
    known_ids = (cell.cast("long") * (1 << 32) + F.greatest(part, F.lit(0))).cast("long")
    return F.when(F.col("doc_id").isNull(), of_nulls).otherwise(known_ids)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (doc_id, ``columns``) with next_<column> of the next document by
    descending doc_id, after the last one the first.

    Documents are ordered within ranges of ids (see id_range); only the first document of each range is looked up by the range before, in the
    partitioning by range that the order needs anyway."""
    tied = docs.withColumn("tie", F.xxhash64(columns[0]))
    cut = tied.withColumn("bucket", id_range(tied))
    order = W.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "tie")
    heads = cut.withColumn("rn", F.row_number().over(order)).where("rn = 1")
    ids = dense_index(tied.withColumn("bucket", id_range(tied)).select("bucket").distinct(), ["bucket"], idx_col="at", group_rows_col="of_all")
    behind = ids.select(F.col("bucket").alias("of"), F.pmod(F.col("at") - 1, F.col("of_all")).alias("at"))  # buckets descend
    follow = behind.join(ids.select("at", "bucket"), "at").select("of", "bucket")
    first = follow.join(heads.select("bucket", F.struct(*columns).alias("head")), "bucket").select("of", "head")
    rows = cut.withColumn("after", F.lead(F.struct(*columns)).over(order))
    met = rows.join(first, F.col("bucket") == F.col("of"), "left").withColumn("after", F.coalesce("after", "head"))
    return met.select("doc_id", *columns, *[F.col(f"after.{c}").alias(f"next_{c}") for c in columns])


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of every text and of its edited text, whose last
    floor(n_chars / 2) code points give way to the first of the next text."""
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(iter([whole]), "text"):
                for batch in slices(iter([part]), "next_text"):
                    texts, after = (batch.column(c).to_pylist() for c in ("text", "next_text"))
                    edited = [t[:len(t) - len(t) // 2] + x[:len(t) // 2] for t, x in zip(texts, after)]
                    own, of_edited, of_next = anchors(texts), anchors(edited), anchors(after)
                    columns = [[len(t) for t in texts], [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                               [as_text(*x) for x in own], [as_text(*x) for x in of_edited],
                               [likeness(x, y) for x, y in zip(own, of_edited)], [likeness(x, y) for x, y in zip(own, of_next)]]
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(texts, ["text"]).select("doc_id", "text", "next_text")
    return pairs.mapInArrow(work, SCHEMA)
