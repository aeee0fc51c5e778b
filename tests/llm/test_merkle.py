import hashlib
import zlib

import pytest

from quire.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = []
    for v in (doc_id, source, lang, n_chars, text):
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha("".join(parts))


def climb(nodes, place, node):
    """(top, siblings) of the plain tree over ``nodes`` with ``node`` at ``place``."""
    nodes, siblings = list(nodes), []
    nodes[place] = node
    while len(nodes) > 1:
        run = place // 16 * 16
        siblings += [x for i, x in enumerate(nodes[run:run + 16], run) if i != place]
        nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        place //= 16
    return nodes[0], siblings


def expected(rows):
    """All results from whole trees built anew for every tampered leaf."""
    trees = {}
    for r in rows:
        trees.setdefault((r[3] is not None, (r[3] or "").encode()), []).append(r)
    order = sorted(trees)
    for rs in trees.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    flat = {t: [leaf(*r) for r in rs] for t, rs in trees.items()}
    subs = [climb(flat[t], 0, flat[t][0])[0] for t in order]
    root = climb(subs, 0, subs[0])[0]
    out = []
    for k, t in enumerate(order):
        for i, r in enumerate(trees[t]):
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[1] and "".join(c.lower() if c.isascii() else c for c in r[1])
            node = leaf(r[0], text if struck else r[1], *r[2:])
            top, low = climb(flat[t], i, node)
            folded, high = climb(subs, k, top)
            out.append((r[0], flat[t][i], subs[k], root, sha("".join(low + high)), folded, folded == root))
    return out


def found(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()]


def same(got, want):
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    same(found(merkle.manifest(spark, edge_docs)), expected([r[:5] for r in edge_rows]))
    assert not merkle.manifest(spark, no_docs).collect()
    one = edge_docs.where("doc_id = 10")
    row = merkle.manifest(spark, one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("") and row.verified


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_of_blocks(spark, levels):
    """Several rounds of small blocks, also above the subroots, and a hot source."""
    rows = [(i, f"Text {i}", "en", f"s{i % 40}" if i % 3 else "hot", i) for i in range(1500)]
    rows += [(2000 + i, "Ünï A", None, None, None) for i in range(17)] + [(2100, "One", "de", "é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    same(found(merkle.manifest(spark, docs, levels)), expected(rows))


def test_block_shares_untouched_nodes():
    block = merkle.Block([sha(str(i)) for i in range(300)], whole=True)
    assert [len(x) for x in block.levels] == [300, 19, 2, 1]
    way = block.siblings(290)
    assert merkle.copies(block.levels[0][290], way)[-1] == block.top
    other = merkle.copies(sha("else"), way)
    assert len(other) == 3 and other[0] != block.levels[1][18] and other[-1] != block.top
    assert merkle.Block(["x"], whole=True).top == "x" and len(merkle.Block(["x"], whole=False).levels) == 4
