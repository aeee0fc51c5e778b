"""Unigram subword vocabulary (T5) and tokenizer (T1c), after the published
Unigram language-model method (Kudo, 2018).

Work is spread by *distinct word*: word frequencies come from a partially
aggregated group-by. Seeds are the maximal repeats of the words, from sorted
suffixes and their common prefixes (see :func:`repeated_pieces`). Each word's
lattice is written once, as the numbers of the seeds at every (start, length);
an EM step only looks probabilities up and runs forward and backward over all
words of one length at a time as arrays, then sums expected counts with a
group-by. Only the vocabulary (the seeds at first) reaches the driver between
iterations.

Pre-tokenisation: white space starts a new word and is kept as a "▁" prefix
(so decoding restores single spaces); a word is also cut after the Tibetan
syllable mark U+0F0B and the shad U+0F0D.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.batches import slices
from quire.session import ship_package

# Fixed values of this tokenizer.
SPACE = "▁"
UNK = "<unk>"
SPECIALS = ("<unk>", "<s>", "</s>")
PRE_TOKEN = r"[^\s་།]*[་།]+|[^\s་།]+"
UNK_PENALTY = 10.0
MAX_VOCAB_BROADCAST = 2_000_000
#: Bytes of text whose words are counted together.
WORD_BYTES = 8 << 20


def pre_tokens(text: str) -> list[str]:
    """Words of a text with the '▁' prefix after white space."""
    out, last = [], 0
    for m in re.finditer(PRE_TOKEN, text):
        piece = m.group(0)
        if m.start() > last or (m.start() > 0 and text[m.start() - 1].isspace()):
            piece = SPACE + piece
        out.append(piece)
        last = m.end()
    return out


# --------------------------------------------------------------------------
# Lattice helpers (per word; a word is short, so these stay small)
# --------------------------------------------------------------------------

def best_path(word: str, logp: dict, max_len: int, unk_logp: float) -> list[str]:
    """Viterbi segmentation maximising the sum of piece log probabilities;
    a character with no piece becomes one unknown piece."""
    n = len(word)
    best = [0.0] + [-math.inf] * n
    back = [0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - max_len), j):
            lp = logp.get(word[i:j])
            if lp is None:
                if j - i != 1:
                    continue
                lp = unk_logp
            s = best[i] + lp
            if s > best[j]:
                best[j], back[j] = s, i
    pieces, j = [], n
    while j > 0:
        i = back[j]
        pieces.append(word[i:j])
        j = i
    return pieces[::-1]


def _logsumexp(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    if b == -math.inf:
        return a
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def expected_counts(word: str, freq: float, logp: dict, max_len: int,
                    prob: dict | None = None) -> tuple[dict, float]:
    """Forward-backward over the word's lattice: expected count of every
    piece (times ``freq``) and the word's log likelihood. Runs on plain
    probabilities (``prob``) and falls back to log space on underflow."""
    if prob is not None:
        got = _expected_counts_prob(word, freq, prob, max_len)
        if got is not None:
            return got
    n = len(word)
    alpha = [-math.inf] * (n + 1)
    alpha[0] = 0.0
    for j in range(1, n + 1):
        acc = -math.inf
        for i in range(max(0, j - max_len), j):
            lp = logp.get(word[i:j])
            if lp is not None and alpha[i] > -math.inf:
                acc = _logsumexp(acc, alpha[i] + lp)
        alpha[j] = acc
    z = alpha[n]
    if z == -math.inf:
        return {}, -math.inf
    beta = [-math.inf] * (n + 1)
    beta[n] = 0.0
    for i in range(n - 1, -1, -1):
        acc = -math.inf
        for j in range(i + 1, min(n, i + max_len) + 1):
            lp = logp.get(word[i:j])
            if lp is not None and beta[j] > -math.inf:
                acc = _logsumexp(acc, lp + beta[j])
        beta[i] = acc
    counts: dict = {}
    for i in range(n):
        if alpha[i] == -math.inf:
            continue
        for j in range(i + 1, min(n, i + max_len) + 1):
            piece = word[i:j]
            lp = logp.get(piece)
            if lp is None or beta[j] == -math.inf:
                continue
            post = math.exp(alpha[i] + lp + beta[j] - z)
            if post > 0:
                counts[piece] = counts.get(piece, 0.0) + post * freq
    return counts, z * freq


def _expected_counts_prob(word: str, freq: float, prob: dict, max_len: int):
    n = len(word)
    arcs = []
    for i in range(n):
        for j in range(i + 1, min(n, i + max_len) + 1):
            p = prob.get(word[i:j])
            if p is not None:
                arcs.append((i, j, p))
    alpha = [0.0] * (n + 1)
    alpha[0] = 1.0
    for i, j, p in arcs:                     # arcs are sorted by start
        alpha[j] += alpha[i] * p
    z = alpha[n]
    if not z > 1e-280:
        return None
    beta = [0.0] * (n + 1)
    beta[n] = 1.0
    for i, j, p in reversed(arcs):
        beta[i] += p * beta[j]
    counts: dict = {}
    scale = freq / z
    for i, j, p in arcs:
        post = alpha[i] * p * beta[j]
        if post > 0:
            piece = word[i:j]
            counts[piece] = counts.get(piece, 0.0) + post * scale
    return counts, math.log(z) * freq


# --------------------------------------------------------------------------
# Spark jobs
# --------------------------------------------------------------------------

def arrow_pre_tokens(texts):
    """Vectorised :func:`pre_tokens` over an Arrow string array: returns a
    flat Arrow array of words (C++ kernels; no per-row Python)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from quire.functions.text import PY_WHITESPACE_CLASS
    ws = f"[{PY_WHITESPACE_CLASS}]+"
    t = pc.fill_null(texts, "")
    lead = pc.match_substring_regex(t, f"^{ws}")                 # text starts with white space
    chunks = pc.split_pattern_regex(t, pattern=ws)               # white-space separated chunks
    n_chunks = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(chunks)
    row = np.repeat(np.arange(len(t)), n_chunks)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    lead_np = lead.to_numpy(zero_copy_only=False)
    after_ws = (pos > 0) | lead_np[row]                          # chunk follows white space
    keep = pc.greater(pc.utf8_length(flat), 0).to_numpy(zero_copy_only=False)
    flat, after_ws = flat.filter(pa.array(keep)), after_ws[keep]
    # \x1f is white space to the split above, so no chunk holds one: a cut mark that no text can contain
    marked = pc.replace_substring_regex(flat, pattern="([་།]+)", replacement="\\1\x1f")
    pieces = pc.split_pattern(marked, pattern="\x1f")
    n_p = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(pieces)
    first = np.zeros(len(words), dtype=bool)
    starts = np.cumsum(n_p) - n_p
    first[starts[n_p > 0]] = True
    prefix = np.repeat(after_ws, n_p) & first
    words = pc.if_else(pa.array(prefix), pc.binary_join_element_wise(SPACE, words, ""), words)
    return words.filter(pc.greater(pc.utf8_length(words), 0))


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, freq) over all pre-tokens: words extracted and counted per
    Arrow batch with C++ kernels (one row per distinct word and batch), then
    summed by a group-by."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for rb in slices(batches, text_col, WORD_BYTES):
            vc = pc.value_counts(arrow_pre_tokens(rb.column(text_col)))
            yield pa.RecordBatch.from_arrays([vc.field("values"), pc.cast(vc.field("counts"), pa.float64())],
                                             names=["word", "freq"])
    ship_package(df.sparkSession)
    per_batch = df.select(text_col).mapInArrow(run, "word string, freq double")
    return per_batch.groupBy("word").agg(F.sum("freq").alias("freq"))


SUFFIXES = "suffix string, c double, low string, high string"
PIECES = "piece string, c double"
#: Distinct suffixes that may share a task's prefix; a prefix with more is cut by its next character.
PREFIX_ROWS = 200_000


def suffixes(words: DataFrame, max_len: int) -> DataFrame:
    """The distinct suffixes of all words, cut at ``max_len`` characters: summed
    frequency, and the least and greatest character that precedes them (empty
    at the start of a word)."""
    def run(batches):
        for rb in batches:
            held: dict = {}
            for w, f in zip(rb.column("word").to_pylist(), rb.column("freq").to_pylist()):
                for i in range(len(w)):
                    s, left = w[i:i + max_len], w[i - 1] if i else ""
                    old = held.get(s)
                    held[s] = (f, left, left) if old is None else (old[0] + f, min(old[1], left), max(old[2], left))
            yield _suffix_batch(held)

    def _suffix_batch(held):
        import pyarrow as pa
        c, low, high = zip(*held.values()) if held else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(c, pa.float64()), pa.array(low, pa.string()),
                                           pa.array(high, pa.string())], ["suffix", "c", "low", "high"])

    ship_package(words.sparkSession)
    return words.select("word", "freq").mapInArrow(run, SUFFIXES).groupBy("suffix").agg(
        F.sum("c").alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))


def hot_prefixes(suffix_rows: DataFrame, limit: int) -> set[str]:
    """All prefixes of more than ``limit`` distinct suffixes, level by level;
    on any level there are fewer of them than rows / limit."""
    hot: set[str] = set()
    level, k = suffix_rows, 1
    while True:
        mine = [r[0] for r in level.where(F.length("suffix") >= k).groupBy(F.substring("suffix", 1, k).alias("p"))
                .count().where(F.col("count") > limit).select("p").collect()]
        if not mine:
            return hot
        hot.update(mine)
        level, k = level.where(F.substring("suffix", 1, k).isin(mine)), k + 1


def _repeats(rows):
    """Maximal repeats of sorted (key, suffix, c, low, high): each interval of
    suffixes with a common prefix is closed as the next suffix leaves it. Of a
    key only what is longer than the key counts, or the key itself; what comes
    after one character alone is part of a longer repeat."""
    def close(node):
        depth, c, low, high, text, key = node
        if depth >= max(2, len(key)) and c > 1 and (low == "" or low != high):
            yield text[:depth], c

    stack, last = [], None
    for key, s, c, low, high in rows:
        common = 0
        if stack and key == last[0]:
            before = last[1]
            top = min(len(before), len(s))
            while common < top and before[common] == s[common]:
                common += 1
        while stack and stack[-1][0] > common:
            node = stack.pop()
            yield from close(node)
            depth = max(common, stack[-1][0] if stack else 0)
            if depth:
                if stack and stack[-1][0] == depth:
                    below = stack.pop()
                    node = (depth, below[1] + node[1], min(below[2], node[2]), max(below[3], node[3]), node[4], node[5])
                stack.append((depth, *node[1:]))
        if stack and stack[-1][0] == len(s):  # equal to the common prefix
            below = stack.pop()
            stack.append((len(s), below[1] + c, min(below[2], low), max(below[3], high), s, key))
        else:
            stack.append((len(s), c, low, high, s, key))
        last = key, s
    while stack:
        node = stack.pop()
        yield from close(node)
        if stack:
            below = stack.pop()
            stack.append((below[0], below[1] + node[1], min(below[2], node[2]), max(below[3], node[3]), *node[4:]))


def repeated_pieces(words: DataFrame, max_len: int, limit: int = PREFIX_ROWS) -> tuple[DataFrame, DataFrame]:
    """(characters, maximal repeats of two characters or more), both (piece, c):
    how often they occur in all words. A repeat is maximal if neither all that
    follows nor all that precedes its places is one same character.

    Suffixes are dealt by prefix, a prefix of more than ``limit`` suffixes by
    its extensions; these few prefixes themselves are counted by a group-by.
    Each task walks its suffixes in order and keeps one stack."""
    table = suffixes(words, max_len).checkpoint()
    chars = table.groupBy(F.substring("suffix", 1, 1).alias("piece")).agg(F.sum("c").alias("c"))
    hot = hot_prefixes(table, limit)

    def keyed(batches):
        import pyarrow as pa
        for rb in batches:
            keys = []
            for s in rb.column("suffix").to_pylist():
                k = 1
                while k <= len(s) and s[:k] in hot:
                    k += 1
                keys.append(s[:k])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *rb.columns], ["key", *rb.schema.names])

    def walk(batches):
        import pyarrow as pa
        out_p, out_c = [], []
        rows = (r for rb in batches for r in zip(*[c.to_pylist() for c in rb.columns]))
        for piece, c in _repeats(rows):
            out_p.append(piece)
            out_c.append(c)
            if len(out_p) >= 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(out_p, pa.string()), pa.array(out_c, pa.float64())], ["piece", "c"])
                out_p, out_c = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_p, pa.string()), pa.array(out_c, pa.float64())], ["piece", "c"])

    dealt = table.mapInArrow(keyed, "key string, " + SUFFIXES) if hot else table.select(F.substring("suffix", 1, 1).alias("key"), "*")
    in_tasks = dealt.repartition("key").sortWithinPartitions("key", "suffix").mapInArrow(walk, PIECES)
    if hot:
        # what a task found at or above a hot prefix is a part of its places only
        whole = [h for h in sorted(hot) if len(h) > 1]
        in_tasks = in_tasks.where(~F.col("piece").isin(whole)) if whole else in_tasks
        for k in sorted({len(h) for h in whole}):
            same = [h for h in whole if len(h) == k]
            rows = table.select(F.substring("suffix", 1, k).alias("piece"), "c", "low", "high", F.substring("suffix", k + 1, 1).alias("after"))
            found = rows.where(F.col("piece").isin(same)).groupBy("piece").agg(
                F.sum("c").alias("c"), F.min("low").alias("low"), F.max("high").alias("high"),
                F.min("after").alias("least"), F.max("after").alias("most"))
            found = found.where("(low = '' or low != high) and (least = '' or least != most)")
            in_tasks = in_tasks.unionByName(found.select("piece", "c"))
    return chars, in_tasks


def seed_pieces(words: DataFrame, seed_size: int, max_len: int | None = None, limit: int = PREFIX_ROWS) -> DataFrame:
    """Initial pieces: every character, and all maximal repeats that cover at
    least as many characters (occurrences x length) as the ``seed_size``-th of
    them does; ties are whole. Without ``max_len`` a piece may be as long as the
    longest word that alone covers that much."""
    if max_len is None:
        max_len = _longest_word(words, seed_size)
    chars, longer = repeated_pieces(words, max_len, limit)
    longer = longer.withColumn("_cover", F.col("c") * F.length("piece")).checkpoint()
    least = longer.select("_cover").orderBy(F.desc("_cover")).limit(seed_size).agg(F.min("_cover")).first()[0]
    return chars.unionByName(longer.where(F.col("_cover") >= (least or 0)).select("piece", "c"))


def _longest_word(words: DataFrame, seed_size: int) -> int:
    """Characters of the longest word among the ``seed_size`` that cover most."""
    cover = F.col("freq") * F.length("word")
    top = words.where("freq > 1").select(F.length("word").alias("n"), cover.alias("c")).orderBy(F.desc("c")).limit(seed_size)
    return max(2, top.agg(F.max("n")).first()[0] or 2)


def digamma(x: float) -> float:
    """psi(x) for x > 0: recurrence up to x >= 10, then the asymptotic series
    (truncation error below 1e-12)."""
    acc = 0.0
    while x < 10.0:
        acc -= 1.0 / x
        x += 1.0
    inv = 1.0 / x
    inv2 = inv * inv
    return acc + math.log(x) - 0.5 * inv - inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 / 240)))


#: A share of all counts below this is no count: it would not survive as a probability.
LEAST_SHARE = 1e-290


def _present(counts: dict, chars: set) -> dict:
    """Counts that have a probability as a float. Between two good pieces a
    third's count can shrink by powers from step to step; on its way to zero its
    share of a large total is zero first, which has no logarithm. Such a count
    is dropped as a zero is, and a character's starts again at 1e-3, so that
    every character stays covered."""
    least = LEAST_SHARE * sum(counts.values())
    kept = {p: c for p, c in counts.items() if c > least}
    for ch in chars:
        kept.setdefault(ch, 1e-3)
    return kept


def _m_step(counts: dict, prior: str) -> dict:
    """Maximum likelihood (``prior="none"``): log(c / total). Bayesian
    (``prior="digamma"``): psi(c) - psi(total), which shrinks rare pieces.
    Expects what :func:`_present` leaves."""
    total = sum(counts.values())
    if prior == "digamma":
        lt = digamma(total)
        return {p: digamma(c) - lt for p, c in counts.items() if c > 0}
    return {p: math.log(c / total) for p, c in counts.items() if c > 0}


LATTICE = "word string, freq double, cells binary"
#: Cells of the lattices that are worked on together.
CELLS = 1 << 21


def lattices(words: DataFrame, pieces: list[str]) -> DataFrame:
    """Each word with the numbers (from 1; 0: none) of the pieces at its places:
    ``cells[start][length - 1]`` as 32-bit integers, up to the longest piece."""
    bc = words.sparkSession.sparkContext.broadcast({p: i for i, p in enumerate(pieces, 1)})
    longest = max(map(len, pieces))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        find = bc.value.get
        for rb in batches:
            out = []
            for w in rb.column("word").to_pylist():
                n = len(w)
                width = min(n, longest)
                out.append(np.array([find(w[i:i + k], 0) if i + k <= n else 0 for i in range(n) for k in range(1, width + 1)],
                                    np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([rb.column("word"), rb.column("freq"), pa.array(out, pa.binary())], ["word", "freq", "cells"])

    return words.select("word", "freq").mapInArrow(run, LATTICE)


def forward_backward(cells, freq, prob, tilt: float):
    """Expected counts of all pieces, and the log likelihood, over words of one
    length: ``cells`` (words, n, width) numbers of pieces, ``prob`` by number
    (0 for number 0). Every character counts ``exp(tilt)``-fold, so that long
    words do not underflow; it cancels out. Also returns which words left the
    range of floats all the same; these are not counted."""
    import numpy as np
    words, n, width = cells.shape
    at = np.ascontiguousarray(cells.transpose(1, 2, 0))
    p = prob[at] * np.exp(tilt * np.arange(1, width + 1))[None, :, None]
    alpha = np.zeros((n + 1, words))
    beta = np.zeros((n + 1, words))
    alpha[0] = beta[n] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(n):
            m = min(width, n - i)
            alpha[i + 1:i + 1 + m] += alpha[i] * p[i, :m]
        for i in range(n - 1, -1, -1):
            m = min(width, n - i)
            beta[i] = (p[i, :m] * beta[i + 1:i + 1 + m]).sum(axis=0)
        z = alpha[n]
        good = (z > 1e-280) & (z < 1e280)
        scale = np.where(good, freq / np.where(good, z, 1.0), 0.0)
        for i in range(n):
            m = min(width, n - i)
            p[i, :m] *= alpha[i] * scale * beta[i + 1:i + 1 + m]
            p[i, m:] = 0.0
    post = np.where(good, p, 0.0)
    counts = np.bincount(at.ravel(), weights=post.ravel(), minlength=len(prob))
    counts[0] = 0.0
    ll = float((np.log(z[good]) * freq[good]).sum() - tilt * n * freq[good].sum())
    return counts, ll, ~good


def _e_step_fn(bc, pieces_bc, tilt):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        prob, pieces = bc.value, pieces_bc.value
        longest = max(map(len, pieces))
        total, likelihood, slow = np.zeros(len(prob)), 0.0, None
        for rb in batches:
            sizes = pc.utf8_length(rb.column("word")).to_numpy(zero_copy_only=False)
            freqs = rb.column("freq").to_numpy(zero_copy_only=False)
            for n in np.unique(sizes[sizes > 0]).tolist():
                width = min(n, longest)
                rows = np.flatnonzero(sizes == n)
                step = max(1, CELLS // (n * width))
                for k in range(0, len(rows), step):
                    some = rows[k:k + step]
                    taken = rb.column("cells").take(pa.array(some))  # all of one size, side by side
                    cells = np.frombuffer(taken.buffers()[2], np.int32, len(some) * n * width).reshape(-1, n, width)
                    counts, ll, bad = forward_backward(cells, freqs[some], prob, tilt)
                    total += counts
                    likelihood += ll
                    for r in some[bad].tolist():  # by logarithms, one by one
                        if slow is None:
                            slow = {p: math.log(x) for p, x in zip(pieces, prob[1:]) if x > 0}, {p: i for i, p in enumerate(pieces, 1)}
                        counts, ll = expected_counts(rb.column("word")[r].as_py(), float(freqs[r]), slow[0], longest)
                        likelihood += ll
                        for p, c in counts.items():
                            total[slow[1][p]] += c
        total[0] = likelihood
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["at", "c"])
    return run


def _prune_fn(bc, max_len, unk_logp):
    def run(batches):
        logp = bc.value
        for pdf in batches:
            losses = []
            for p, c in zip(pdf["piece"], pdf["c"]):
                if len(p) == 1:
                    losses.append(math.inf)
                    continue
                own = logp[p]
                del logp[p]
                alt = best_path(p, logp, max_len, unk_logp)
                logp[p] = own
                alt_lp = sum(logp.get(a, unk_logp) for a in alt)
                losses.append(c * (own - alt_lp))
            yield pd.DataFrame({"piece": pdf["piece"], "c": pdf["c"], "loss": losses})
    return run


def train_unigram(df: DataFrame, vocab_size: int, text_col: str = "text", max_len: int | None = None,
                  seed_size: int | None = None, shrink: float = 0.75, em_steps: int = 2,
                  prior: str = "none") -> DataFrame:
    """Train a Unigram vocabulary of ``vocab_size`` entries (specials
    included). Seeds: every character, and the maximal repeats that cover most,
    about ``seed_size`` (ten times ``vocab_size`` by default) of any length that
    frequent words have (see :func:`seed_pieces`); ``max_len`` bounds their
    length. Every character stays in the vocabulary, so ``vocab_size`` must
    hold them all. Returns (id, piece, score = log probability). ``prior``
    selects the M-step (see :func:`_m_step`)."""
    if prior not in ("none", "digamma"):
        raise ValueError("prior must be 'none' or 'digamma'")
    import numpy as np

    from quire.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    # The word table is small in bytes but each row costs a lattice pass, so
    # it is spread over all cores before being checkpointed and reused.
    spread = max(2 * spark.sparkContext.defaultParallelism, 8)
    words = word_counts(df, text_col).repartition(spread, "word").checkpoint(eager=True)
    pieces = {r["piece"]: r["c"] for r in seed_pieces(words, seed_size or 10 * vocab_size, max_len).collect()}
    target = vocab_size - len(SPECIALS)
    chars = {p for p in pieces if len(p) == 1}
    if len(chars) > target:
        raise ValueError(f"the text has {len(chars)} distinct characters, which all stay; vocab_size must be at least "
                         f"{len(chars) + len(SPECIALS)}")
    if not pieces:
        return spark.createDataFrame([(i, p, 0.0) for i, p in enumerate(SPECIALS)], "id int, piece string, score double")
    names = sorted(pieces)
    longest = max(map(len, names))
    names_bc = spark.sparkContext.broadcast(names)
    lattice = lattices(words, names).checkpoint(eager=True)
    characters = words.agg(F.sum(F.col("freq") * F.length("word"))).first()[0]

    def normalise(counts: dict) -> dict:
        total = sum(counts.values())
        return {p: math.log(c / total) for p, c in counts.items() if c > 0}

    logp = normalise(pieces)
    singles = {c: pieces[c] for c in chars}       # a first guess at what a character costs
    tilt = -sum(singles[c] * logp[c] for c in chars) / sum(singles.values()) / 2
    while True:                                   # each round removes pieces, so the target is reached
        for _ in range(em_steps):
            bc = spark.sparkContext.broadcast(np.array([0.0, *[math.exp(logp[p]) if p in logp else 0.0 for p in names]]))
            sums = (lattice.mapInArrow(_e_step_fn(bc, names_bc, tilt), "at long, c double")
                           .groupBy("at").agg(F.sum("c").alias("c")).collect())
            counts = {names[r["at"] - 1]: r["c"] for r in sums if r["at"]}
            tilt = -sum(r["c"] for r in sums if not r["at"]) / characters
            bc.unpersist()
            logp = _m_step(_present(counts, chars), prior)
        if len(logp) <= target:
            break
        keep_n = max(target, min(int(len(logp) * shrink), len(logp) - 1))
        bc = spark.sparkContext.broadcast(logp)
        unk_logp = min(logp.values()) - UNK_PENALTY
        scored = spark.createDataFrame(
            [(p, float(math.exp(v))) for p, v in logp.items()], "piece string, c double")
        kept = (scored.repartition(max(1, spark.sparkContext.defaultParallelism))
                      .mapInPandas(_prune_fn(bc, longest, unk_logp), "piece string, c double, loss double")
                      .orderBy(F.col("loss").desc(), F.col("piece")).limit(keep_n)
                      .select("piece").collect())
        bc.unpersist()
        least = [r["piece"] for r in kept]        # the characters count within the target
        extra = len(chars - set(least))
        keep = chars | {p for p in least[:len(least) - extra] if p not in chars} | (chars & set(least))
        logp = normalise({p: math.exp(v) for p, v in logp.items() if p in keep})
    ranked = sorted(logp.items(), key=lambda kv: (-kv[1], kv[0]))
    non_char = [kv for kv in ranked if len(kv[0]) > 1]
    char_items = [kv for kv in ranked if len(kv[0]) == 1]
    room = max(0, target - len(char_items))
    final = sorted(char_items + non_char[:room], key=lambda kv: (-kv[1], kv[0]))
    rows = [(i, p, 0.0) for i, p in enumerate(SPECIALS)]
    rows += [(len(SPECIALS) + i, p, float(s)) for i, (p, s) in enumerate(final)]
    return spark.createDataFrame(rows, "id int, piece string, score double")


def _tokenise_fn(bc, text_col, passthrough, max_len, bos_id, eos_id):
    def run(batches):
        import pyarrow as pa
        logp, ids, unk_id, unk_logp = bc.value
        memo: dict = {}
        for rb in slices(batches, text_col):
            texts = rb.column(text_col).to_pylist()
            out = []
            for t in texts:
                seq = [] if bos_id is None else [bos_id]
                for w in pre_tokens(t or ""):
                    seg = memo.get(w)
                    if seg is None:
                        seg = [ids.get(p, unk_id) for p in best_path(w, logp, max_len, unk_logp)]
                        if len(memo) < 200_000:
                            memo[w] = seg
                    seq.extend(seg)
                if eos_id is not None:
                    seq.append(eos_id)
                out.append(seq)
            ids_arr = pa.array(out, pa.list_(pa.int32()))
            mask = pa.array([[1] * len(s) for s in out], pa.list_(pa.int32()))
            cols = [rb.column(c) for c in passthrough] + [ids_arr, mask]
            yield pa.RecordBatch.from_arrays(cols, names=list(passthrough) + ["input_ids", "attention_mask"])
    return run


def tokenise_unigram(df: DataFrame, vocab: DataFrame, text_col: str = "text",
                     bos: bool = True, eos: bool = True) -> DataFrame:
    """Best-path segmentation of every word (T1c); narrow Arrow batch map,
    vocabulary broadcast after a size check, per-task word memo. Pieces of any
    length are used."""
    ship_package(df.sparkSession)
    n = vocab.count()
    if n > MAX_VOCAB_BROADCAST:
        raise ValueError(f"vocabulary of {n} entries is above the broadcast bound")
    rows = vocab.select("id", "piece", "score").collect()
    ids = {r["piece"]: int(r["id"]) for r in rows}
    logp = {r["piece"]: float(r["score"]) for r in rows if r["piece"] not in SPECIALS}
    unk_logp = (min(logp.values()) if logp else 0.0) - UNK_PENALTY
    max_len = max(map(len, logp), default=1)
    bc = df.sparkSession.sparkContext.broadcast((logp, ids, ids.get(UNK, 0), unk_logp))
    passthrough = [c for c in df.columns if c != text_col]
    schema = T.StructType([df.schema[c] for c in passthrough] + [
        T.StructField("input_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType(), False))])
    return df.mapInArrow(_tokenise_fn(bc, text_col, passthrough, max_len,
                                      ids.get("<s>") if bos else None, ids.get("</s>") if eos else None), schema)


def decode_unigram(pieces: list[str]) -> str:
    """Pieces back to text: concatenation, '▁' read as a space."""
    return "".join(pieces).replace(SPACE, " ")


def decode_unigram_table(df: DataFrame, vocab: DataFrame, ids_col: str = "input_ids", unk: str = "<unk>") -> DataFrame:
    """``ids_col`` -> ``text`` (T4): pieces in order, their mark of white space
    read as a space, control pieces dropped; an id that is unknown or outside
    the vocabulary becomes ``unk``, a null list an empty text. What
    :func:`pre_tokens` does not keep is lost: white space comes back as single
    spaces, none at the end."""
    ship_package(df.sparkSession)
    n = vocab.count()
    if n > MAX_VOCAB_BROADCAST:
        raise ValueError(f"vocabulary of {n} entries is above the broadcast bound")
    names = {int(r["id"]): r["piece"] for r in vocab.select("id", "piece").collect()}
    said = [unk if names.get(i, UNK) == UNK else "" if names[i] in SPECIALS else names[i].replace(SPACE, " ")
            for i in range(max(names, default=-1) + 1)]
    bc = df.sparkSession.sparkContext.broadcast([*said, unk])
    keep = [c for c in df.columns if c != ids_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("text", T.StringType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        pieces = pa.array(bc.value, pa.large_string())
        outside = len(pieces) - 1
        for rb in slices(batches, ids_col):
            ids = rb.column(ids_col)
            lens = np.where(np.asarray(ids.is_valid()), pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False), 0)
            flat = pc.fill_null(pc.list_flatten(ids), outside).to_numpy(zero_copy_only=False)
            flat = np.where((flat < 0) | (flat > outside), outside, flat)
            offsets = np.concatenate(([0], np.cumsum(lens)))
            words = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pieces.take(pa.array(flat, pa.int64())))
            texts = pc.cast(pc.binary_join(words, pa.scalar("", pa.large_string())), pa.string())
            yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in keep], texts], [*keep, "text"])

    return df.select(*keep, ids_col).mapInArrow(run, schema)
