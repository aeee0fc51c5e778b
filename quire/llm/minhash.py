"""Near-duplicate detection with fast similarity sketches, banding and exact
verification.

A document's set holds its distinct shingles of ``words`` words (lower case,
A-Z). The sketch is filled in rounds: in each of the first T rounds every
shingle is placed into a hashed bin with the value (round, hash), the least
value of a bin stays, and the rounds end as soon as every bin is full; after T
rounds, round T + j places every shingle into bin j, so that all T coordinates
are full in the end. Equal coordinates estimate the likeness with the same
concentration as independent minima.

BANDS keys of ROWS coordinates each bring candidates together: a pair of
likeness 0.8 misses all of them with a chance of (1 - 0.8^4)^32 = 5e-8.

Work is linear in the group: documents with equal sets are one class; in a
bucket every class is compared with the first one only, on the full sets. What
this leaves apart in a bucket (classes of different components) is then
compared within tasks, block by block, by longer sketches of FINE coordinates;
a pair is looked at in the first bucket that it shares only (told by the 64-bit
keys of the buckets themselves), and those that can
be as alike as asked (4.5 standard deviations below 0.8, a chance of 3e-6 to
miss one) are compared on the full sets as well. Components come from the links.

Defined cases: a null or empty text and one without words has the empty set
and is linked with nothing; fewer words than a shingle make one shingle of all
of them; rows that repeat a doc_id are one document that has the links of each
of them; a null doc_id is a component of its own (null) and kept; an empty
table gives an empty result. Other columns are ignored.
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

T, BANDS, ROWS, FINE = 128, 32, 4, 512
#: Standard deviations of the estimate that a pair worth comparing may lie below the likeness asked for.
SLACK = 4.5
#: Members of a bucket that a task compares with as many others at once.
BLOCK = 1024


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct shingles, sorted."""
    data, offsets = joined(texts)
    start, stop, doc = ws.word_spans(data, offsets)
    hashes = ws.spans_hash(ws.prefix_sums(ws.LOWER[data]), start, stop)
    found, place = ws.windows(hashes, doc, n)
    owner = doc[place]
    count = np.bincount(doc, minlength=len(texts))
    for k in range(1, n):  # texts of k words: all of them, apart from any longer string
        few = count[doc] == k
        if few.any():
            short, at = ws.windows(hashes[few], doc[few], k)
            found = np.concatenate((found, ws.mix(short + np.uint64(k))))
            owner = np.concatenate((owner, doc[few][at]))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], found[new]


def sketches(owner: np.ndarray, hashes: np.ndarray, n_docs: int, t: int = T) -> np.ndarray:
    """t coordinates of every document; those of an empty set stay at the
    largest value."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(n_docs * t, empty, np.uint64)
    low = np.uint64((1 << 48) - 1)
    for i in range(2 * t):
        if not len(hashes):
            break
        h = ws.mix(hashes ^ ws.mix(np.array([i + 1], np.uint64) * ws.BASE)[0])
        place = (h >> np.uint64(48)).astype(np.int64) % t if i < t else i - t
        np.minimum.at(bins, owner * t + place, (np.uint64(i) << np.uint64(48)) | (h & low))
        open_docs = (bins.reshape(n_docs, t) == empty).any(1)
        left = open_docs[owner]
        owner, hashes = owner[left], hashes[left]
    return bins.reshape(n_docs, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sketch), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            keys = keys * np.uint64(0xC2B2AE3D27D4EB4F) + ws.mix(sketch[:, r::ROWS])
        return ws.mix(keys + np.arange(BANDS, dtype=np.uint64) * ws.BASE).view(np.int64)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, class, bands): class is equal for equal sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = batch.num_rows
            owner, hashes = shingle_sets(batch.column("text"), n)
            size = np.bincount(owner, minlength=rows)
            ends = np.cumsum(size)
            sums = []
            with np.errstate(over="ignore"):
                for seed in (1, 2):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ws.mix(hashes + np.uint64(seed) * ws.BASE), dtype=np.uint64)))
                    sums.append(total[ends] - total[ends - size])
            classes = np.stack([*sums], 1).astype("<u8").tobytes()
            keys = band_keys(sketches(owner, hashes, rows))
            some = size > 0
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size, pa.int64()),
                pa.array([classes[16 * i:16 * i + 16] if s else None for i, s in enumerate(some)], pa.binary()),
                pa.array([k if s else None for k, s in zip(keys, some)], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "class", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        work, "doc_id long, n_shingles long, class binary, bands array<long>")


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingles): the whole set, sorted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, hashes = shingle_sets(batch.column("text"), n)
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=batch.num_rows)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        work, "doc_id long, shingles array<long>")


def set_sketches(sets: DataFrame) -> DataFrame:
    """(node, n, keys, fine): the band keys of the sketch, and 16 bits of each
    coordinate of the longer one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                lists = batch.column("shingles")
                size = np.asarray(lists.value_lengths()).astype(np.int64)
                hashes = lists.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(batch.num_rows), size)
                columns = [batch.column("node"), pa.array(size)]
                keys = band_keys(sketches(owner, hashes, batch.num_rows)).astype("<i8").tobytes()
                fine = ws.mix(sketches(owner, hashes, batch.num_rows, FINE)).astype("<u2").tobytes()
                for raw, width in ((keys, 8 * BANDS), (fine, 2 * FINE)):
                    columns.append(pa.array([raw[width * i:width * (i + 1)] for i in range(batch.num_rows)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "keys", "fine"])

    return sets.select(F.col("doc_id").alias("node"), "shingles").mapInArrow(work, "node long, n long, keys binary, fine binary")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links. Each
    round hangs every node's neighbours and the node itself under the smallest
    of them, alternately the larger and the smaller neighbours, until the links
    are stars; a chain of n links takes about log n rounds."""
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct().checkpoint()

    def total(df: DataFrame) -> tuple:
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    state = total(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        links = (large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct().checkpoint())
        now = total(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) as alike as asked, on their full sets."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return (pairs.join(one, "a").join(two, "b")
            .where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b").distinct())


def _apart(percent: int):
    """Within each bucket (pair of blocks of a bucket), the pairs of different
    components that can be as alike as asked and share no earlier bucket."""
    least = percent / 100 - SLACK * (percent / 100 * (1 - percent / 100) / FINE) ** 0.5

    def pairs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(rows["side"] != 1), np.flatnonzero(rows["side"] != 0)
        one_block = rows["side"][0] == 2
        got: tuple[list, list] = [], []
        for at in range(0, len(left), 64):
            i = left[at:at + 64]
            small = np.minimum(rows["n"][i][:, None], rows["n"][right])
            large = np.maximum(rows["n"][i][:, None], rows["n"][right])
            fits = (100 * small >= percent * large) & (rows["component"][i][:, None] != rows["component"][right])
            if one_block:
                fits &= rows["node"][i][:, None] > rows["node"][right]
            p, q = np.nonzero(fits)
            for k in range(0, len(p), 1 << 14):
                x, y = i[p[k:k + (1 << 14)]], right[q[k:k + (1 << 14)]]
                first = (rows["keys"][x] == rows["keys"][y]).argmax(1) == rows["band"][x]  # whole keys, as the buckets have them
                x, y = x[first], y[first]
                alike = (rows["fine"][x] == rows["fine"][y]).mean(1) >= least
                got[0].append(rows["node"][x[alike]])
                got[1].append(rows["node"][y[alike]])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *got[0]]), np.concatenate([none, *got[1]])

    def work(key: tuple, table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).to_numpy() for c in ("node", "component", "n", "side", "band")}
        for c, kind, t in (("keys", "<i8", BANDS), ("fine", "<u2", FINE)):
            rows[c] = np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(-1, t)
        x, y = pairs(rows)
        return pa.table({"a": np.maximum(x, y), "b": np.minimum(x, y)})

    return work


@frees_shuffles
def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    path = scratch_path(spark, "signatures")
    signatures(docs, words).write.parquet(path)
    signed = spark.read.parquet(path)
    classes = signed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("node")).where("node is not null")
    members = signed.where("class is not null").join(classes, "class")
    # a class is seen through its first document
    firsts = members.where("doc_id = node").select("node", "class", "bands").dropDuplicates(["node", "class"])
    keyed = firsts.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    star = (keyed.join(buckets.select("key", "first"), "key").where("node > first")
            .select(F.col("node").alias("a"), F.col("first").alias("b")).distinct().checkpoint())
    wanted = star.select(F.col("a").alias("doc_id")).unionByName(star.select(F.col("b").alias("doc_id"))).distinct()
    sets_path = scratch_path(spark, "sets")
    full_sets(docs.join(wanted, "doc_id", "left_semi"), words).write.parquet(sets_path)
    sets = spark.read.parquet(sets_path)
    links = _verified(star, sets, percent).checkpoint()
    first_round = components(links)

    # buckets that hold several components still
    placed = keyed.join(first_round, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    mixed = (placed.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("key", "members"))
    around = placed.join(mixed, "key").checkpoint()
    sketched = set_sketches(sets.join(around.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    around = around.join(sketched, "node")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    cut = around.select("*", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    dealt = cut.select(
        "key", "band", "node", "component", "n", "keys", "fine", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", "band", "node", "component", "n", "keys", "fine", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))
    more = (dealt.groupBy("key", "p", "q").applyInArrow(_apart(percent), "a long, b long").where("a != b").distinct()
            .join(star, ["a", "b"], "left_anti").checkpoint())
    late = _verified(more, sets, percent)
    found = components(links.unionByName(late))

    labels = members.select("doc_id", "node").distinct().join(found, "node", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "node")).alias("component_id"))
    out = signed.join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
