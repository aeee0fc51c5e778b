"""Entry A of the reference as one Spark job chain: corpus folder -> lines
-> tokens -> blocks (cached per source) -> exact train/test split -> caps.

    blocks, manifest = prepare_blocks(spark, "/data/corpus", "/shared/cache", block=256)
    train, test = split_and_cap(blocks, frac=0.005, seed=42)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.dataset import cap, split_exact
from quire.operators.pack import effective_block_size, pack
from quire.operators.tokenise import tokenise_codepoint
from quire.sources.corpus import first_source, scan_corpus
from quire.sources.sinks import materialise


def prepare_blocks(spark: SparkSession, corpus_dir: str, cache_root: str, block: int | None = 256,
                   model_max: int | None = None, tokenise: Callable[[DataFrame], DataFrame] = tokenise_codepoint,
                   tokenizer_fp: str = "codepoint-v1", debug_first_only: bool = False,
                   overwrite_cache: bool = False, mode: str = "global") -> tuple[DataFrame, DataFrame]:
    """Scan, tokenise and pack every ``*.txt`` of ``corpus_dir``, reusing
    cached blocks of unchanged sources. Returns (blocks, manifest)."""
    size = effective_block_size(block, model_max)
    lines = scan_corpus(spark, corpus_dir)
    if debug_first_only:
        lines = first_source(lines)

    from quire.operators.tokenise import codepoint_size
    count = codepoint_size("text") if tokenise is tokenise_codepoint else None

    def build(todo: DataFrame) -> DataFrame:
        return pack(todo, block=size, order=["line_no"], mode=mode, tokenise=tokenise, size=count)

    return materialise(lines, build, cache_root, size, tokenizer_fp, overwrite=overwrite_cache)


def split_and_cap(blocks: DataFrame, frac: float, seed: int, max_train: int | None = None,
                  max_eval: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Exact shuffled split, then the optional row caps of each side."""
    s = split_exact(blocks, frac, seed, ["source", "block_id"])
    train = s.where(F.col("split") == "train").drop("split")
    test = s.where(F.col("split") == "test").drop("split")
    if max_train is not None:
        train = cap(train, max_train, seed, ["source", "block_id"])
    if max_eval is not None:
        test = cap(test, max_eval, seed, ["source", "block_id"])
    return train, test


def with_validation_files(spark: SparkSession, corpus_dir: str, validation_paths: list[str], cache_root: str,
                          block: int | None = 256, model_max: int | None = None,
                          tokenise: Callable[[DataFrame], DataFrame] = tokenise_codepoint,
                          tokenizer_fp: str = "codepoint-v1") -> tuple[DataFrame, DataFrame]:
    """Named validation files replace the split (S12): train = every block of
    the corpus folder, test = the blocks of the validation files, each packed
    and cached the same way (separate cache roots)."""
    size = effective_block_size(block, model_max)
    from quire.operators.tokenise import codepoint_size
    count = codepoint_size("text") if tokenise is tokenise_codepoint else None

    def build(todo: DataFrame) -> DataFrame:
        return pack(todo, block=size, order=["line_no"], tokenise=tokenise, size=count)

    train, _ = prepare_blocks(spark, corpus_dir, f"{cache_root.rstrip('/')}/train", block=size,
                              tokenise=tokenise, tokenizer_fp=tokenizer_fp)
    val_lines = scan_corpus(spark, paths=list(validation_paths))
    test, _ = materialise(val_lines, build, f"{cache_root.rstrip('/')}/validation", size, tokenizer_fp)
    return train, test
