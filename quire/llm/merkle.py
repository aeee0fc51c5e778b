"""Merkle manifest of a dataset, as a persistent tree with path copying.

A document's leaf is the SHA-256 of its fields. Leaves of a source ascend by
doc_id; every FAN consecutive nodes become one until one remains, the source's
subroot; the subroots, by source, become the root in the same way.

The tree is built in aligned blocks of FAN^LEVELS nodes, each a group of its
own: a block gives one node, these nodes are the leaves of the next round, and
so on, so that a round has FAN^LEVELS times fewer rows than the one before. On the
way back every block gets the siblings of its own ancestors, one row a block.

Each tampered leaf makes a version of the tree. It shares all nodes with the
first version but its ancestors: within the block of the leaf these are copied
with one child replaced; above it the version goes on from the block's row of
ancestors, so that versions stay spread over the blocks of their leaves and no
node of an upper level meets all versions below it. ``folded_root`` is the root
of a leaf's version, ``verified`` tells whether it is the root of the first.

Defined cases: null fields have marks of their own (see ``field``); a null
source is a source, the first one; a null doc_id comes first and is not
tampered; rows of a repeated doc_id are ordered by their leaves, so that
repeated rows have equal leaves side by side; empty texts are empty values; a
text without A-Z is tampered without a change and stays verified; a single leaf
is its subroot, a single subroot the root, and their proof that of no siblings;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.index import range_rank
from quire.session import scratch_path, ship_package

FAN, LEVELS = 16, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "tree string, idx long, hash string"
ABOVE = "tree string, block long, path array<struct<left:string,right:string>>, subroot string, root string"
PROVEN = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
          "tampered boolean, copied int")


def field(name: str, value: Column | None = None) -> Column:
    """A null is ``-``, any other value its bytes, a colon and the value."""
    text = (F.col(name) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered): the leaf of every document, and of its
    tampered form where it is tampered. ``tree`` orders as sources do, null first."""
    def leaf(text: Column | None) -> Column:
        return F.sha2(F.concat(*[field(c) for c in ("doc_id", "source", "lang", "n_chars")], field("text", text)), 256)

    struck = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("")).alias("tree"), "doc_id", leaf(None).alias("leaf"),
        F.when(struck, leaf(F.translate("text", UPPER, LOWER))).alias("tampered"))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """An aligned block of nodes. ``whole`` blocks are all of their tree and end
    with one node; others always have ``levels`` levels above."""

    def __init__(self, nodes: list[str], whole: bool, levels: int = LEVELS) -> None:
        self.levels = [nodes]
        while len(self.levels) <= levels and not (whole and len(self.levels[-1]) == 1):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> list[tuple[str, str]]:
        """What stands to the left and right of the node's ancestors, upwards."""
        out = []
        for level in self.levels[:-1]:
            run = place - place % FAN
            out.append(("".join(level[run:place]), "".join(level[place + 1:run + FAN])))
            place //= FAN
        return out


def copies(node: str, siblings: list[tuple[str, str]]) -> list[str]:
    """A version's own nodes above ``node``; all others are shared."""
    out = []
    for left, right in siblings:
        node = digest(left + node + right)
        out.append(node)
    return out


def _block(table: pa.Table, column: str, levels: int) -> tuple[pa.Table, int, Block]:
    table, size = table.sort_by("idx"), FAN ** levels
    number = table.column("idx")[0].as_py() // size
    nodes = table.column(column).to_pylist()
    return table, number, Block(nodes, number == 0 and len(nodes) < size, levels)


def _up(table: pa.Table, levels: int) -> pa.Table:
    table, number, block = _block(table, "hash", levels)
    return pa.table({"tree": table.column("tree").slice(0, 1), "idx": [number], "hash": [block.top]})


def _down(table: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """The way to the root for every node, each the top of a block below."""
    table, _, block = _block(table, "hash", levels)
    over, n = above.to_pylist()[0], table.num_rows
    upper = [(x["left"], x["right"]) for x in over["path"]]
    paths = [[{"left": a, "right": b} for a, b in block.siblings(i) + upper] for i in range(n)]
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"tree": table.column("tree"), "block": table.column("idx"), "path": pa.array(paths, kind),
                     "subroot": pa.array([over["subroot"]] * n, pa.string()), "root": pa.array([over["root"]] * n, pa.string())})


def _prove(table: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    table, _, block = _block(table, "leaf", levels)
    over, n = above.to_pylist()[0], table.num_rows
    upper = [(x["left"], x["right"]) for x in over["path"]]
    rest = "".join(a + b for a, b in upper)
    roots: dict[str, str] = {}  # of the block's versions, by the block's top
    proofs, folded, made = [], [], []
    originals, struck = block.levels[0], table.column("tampered").to_pylist()
    for i in range(n):
        siblings = block.siblings(i)
        leaf = struck[i] or originals[i]
        own = copies(leaf, siblings)
        top = own[-1] if own else leaf
        if top not in roots:
            roots[top] = (copies(top, upper) or [top])[-1]
        proofs.append(digest("".join(a + b for a, b in siblings) + rest))
        folded.append(roots[top])
        made.append(len(own) + len(upper) if leaf != originals[i] else 0)
    root = over["root"]
    return pa.table({
        "doc_id": table.column("doc_id"), "leaf": table.column("leaf"), "subroot": pa.array([over["subroot"]] * n, pa.string()),
        "root": pa.array([root] * n, pa.string()), "proof_sha256": proofs, "folded_root": folded,
        "verified": [x == root for x in folded], "tampered": [x is not None for x in struck], "copied": pa.array(made, pa.int32())})


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {FAN ** levels}"))


def _rounds(spark: SparkSession, nodes: DataFrame, levels: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The nodes of every round after the first, and the trees whose top was
    reached in each: (tree, hash)."""
    rounds, tops = [], []
    while True:
        path = scratch_path(spark, "merkle-round")
        _with_block(nodes, levels).groupBy("tree", "block").applyInArrow(lambda t: _up(t, levels), NODE).write.parquet(path)
        made = spark.read.parquet(path)
        tall = made.where("idx > 0").select("tree").distinct()
        tops.append(made.join(tall, "tree", "left_anti").select("tree", "hash"))
        if tall.isEmpty():
            return rounds, tops
        nodes = made.join(tall, "tree", "left_semi")
        rounds.append(nodes)


def _below(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    return (_with_block(nodes, levels).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
            .applyInArrow(lambda t, a: _down(t, a, levels), ABOVE))


def _ways(rounds: list[DataFrame], tops: list[DataFrame], levels: int) -> DataFrame:
    """The way to the root for every block of the first round; ``tops`` has for
    each round the ways (tree, path, subroot, root) of the trees that end there."""
    above = None
    for nodes, ended in zip([*rounds, None][::-1], tops[::-1]):
        here = ended.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        above = here if above is None else here.unionByName(_below(nodes, above, levels))
    return above


def manifest(spark: SparkSession, docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A row for each document: its leaf, subroot, root and proof, the root of
    its version, and how many nodes that version copied."""
    ship_package(spark)
    ranked = range_rank(leaves(docs), ["tree"], ["doc_id", "leaf"])
    rounds, tops = _rounds(spark, ranked.select("tree", "idx", F.col("leaf").alias("hash")), levels)
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    ordered = range_rank(subroots.select("tree", F.col("hash").alias("subroot")), [], ["tree"])
    upper, ends = _rounds(spark, ordered.select(F.lit("").alias("tree"), "idx", F.col("subroot").alias("hash")), levels)
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = [e.select("tree", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root")) for e in ends]
    above = _ways(upper, top, levels)  # of the blocks of subroots
    nodes = ordered.select(F.lit("").alias("tree"), "idx", F.col("subroot").alias("hash"))
    path = scratch_path(spark, "merkle-subroots")
    _below(nodes, above, levels).withColumnRenamed("block", "idx").join(
        ordered.select("idx", F.col("tree").alias("of"), F.col("subroot").alias("own")), "idx").select(
        F.col("of").alias("tree"), "path", F.col("own").alias("subroot"), "root").write.parquet(path)
    ways = spark.read.parquet(path)
    above = _ways(rounds, [t.select("tree").join(ways, "tree") for t in tops], levels)
    return (_with_block(ranked, levels).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
            .applyInArrow(lambda t, a: _prove(t, a, levels), PROVEN))
