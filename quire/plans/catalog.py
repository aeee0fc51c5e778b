"""The registered queries: one function (spark, sf_dir) -> DataFrame per
strings so they compare exactly with the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.arrays import argmax, drop_special, label_typing
from quire.functions.text import (cut_at_stop, drop_markers, extract_answer, is_blank, py_strip,
                                  render_prompt, source_key, url_host)
from quire.operators import dataset as ds
from quire.operators import evaluate as ev
from quire.operators import infer, keyed
from quire.operators import tokenise as tk
from quire.operators import unigram as ug
from quire.operators import vocab as vc
from quire.operators.index import dense_index
from quire.operators.pack import accounting, pack
from quire.operators.tokenise import codepoint_size, tokenise_codepoint
from quire.session import scratch_path
from quire.sources import corpus as src
from quire.sources.sinks import materialise
from quire.sources.tables import table
from quire.streaming import stream as st

BLOCK = 256
SEED = 42
LINE_BUCKET_DOCS = 1024


def ids_text(col: str = "input_ids"):
    return F.array_join(F.col(col), ",")


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "source", "text")))


def doc_lines(spark, sf_dir) -> DataFrame:
    """Lines of each document: (source, doc_id, pos, text)."""
    d = documents(spark, sf_dir, "source", "doc_id", "text")
    return d.select("source", "doc_id",
                    F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
            .select("source", "doc_id", F.col("pos").cast("long").alias("pos"), F.col("line").alias("text"))


def cp_tokens(spark, sf_dir) -> DataFrame:
    return tokenise_codepoint(documents(spark, sf_dir, "source", "doc_id", "text"))


def cp_blocks(spark, sf_dir, remainder: str = "reference", mode: str = "global") -> DataFrame:
    """Documents -> code point blocks; tokenised once, after the offsets."""
    return pack(documents(spark, sf_dir, "source", "doc_id", "text"), block=BLOCK, mode=mode,
                remainder=remainder, tokenise=tokenise_codepoint, size=codepoint_size("text"))


# --- section 2.1 / 2.3 / 2.4: minimum slice --------------------------------

def q_scan_lines(spark, sf_dir):
    return doc_lines(spark, sf_dir)


def q_line_numbers(spark, sf_dir):
    lines = doc_lines(spark, sf_dir).select("source", "doc_id", "pos")
    return dense_index(lines, order=["doc_id", "pos"], group=["source"],
                       bucket=[F.floor(F.col("doc_id") / LINE_BUCKET_DOCS)], idx_col="line_no")


def q_tokenise_codepoint(spark, sf_dir):
    t = cp_tokens(spark, sf_dir)
    return t.select("source", "doc_id", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_text().alias("ids"))


def q_pack_global(spark, sf_dir):
    b = cp_blocks(spark, sf_dir)
    return b.select("source", "block_id", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_text().alias("ids"))


def q_pack_accounting(spark, sf_dir):
    return accounting(cp_tokens(spark, sf_dir), cp_blocks(spark, sf_dir))


QUERIES = {
    "scan_lines": q_scan_lines,
    "line_numbers": q_line_numbers,
    "tokenise_codepoint": q_tokenise_codepoint,
    "pack_global": q_pack_global,
    "pack_accounting": q_pack_accounting,
}


# --- section 2.4: packing variants, dataset operations ------------------------


SPLIT_FRAC = 0.05
CAP_ROWS = 100
MIX_WEIGHTS = {"other": 3, "en": 4}
BATCH = 12
ACCUM = 8
SHARDS = 3


def line_tokens(spark, sf_dir) -> DataFrame:
    return tokenise_codepoint(doc_lines(spark, sf_dir))


def q_pack_batch(spark, sf_dir):
    b = pack(doc_lines(spark, sf_dir), block=BLOCK, mode="batch", order=["doc_id", "pos"],
             bucket=[F.floor(F.col("doc_id") / LINE_BUCKET_DOCS)], workers=8, batch_rows=1000,
             tokenise=tokenise_codepoint, size=codepoint_size("text"))
    return b.select("source", "block_id", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_text().alias("ids"))


def q_pack_pad(spark, sf_dir):
    b = cp_blocks(spark, sf_dir, remainder="pad")
    return b.select("source", "block_id",
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("n_real"),
                    ids_text().alias("ids"), ids_text("labels").alias("labels"))


def q_concat_sources(spark, sf_dir):
    docs = documents(spark, sf_dir, "lang", "source", "doc_id", "text")
    langs = [r["lang"] for r in docs.select("lang").distinct().collect()]
    parts = [(lang, pack(tokenise_codepoint(docs.where(F.col("lang").eqNullSafe(lang)).drop("lang")), block=BLOCK))
             for lang in langs]
    out = ds.concat_sources(parts, order=["source", "block_id"])
    return out.select("part", "source", "block_id", "row_idx",
                      F.size("input_ids").cast("long").alias("n_tokens"))


def split_blocks(spark, sf_dir) -> DataFrame:
    b = cp_blocks(spark, sf_dir).select("source", "block_id", "input_ids")
    return ds.split_exact(b, SPLIT_FRAC, SEED, ["source", "block_id"])


def q_split_test(spark, sf_dir):
    return split_blocks(spark, sf_dir).where("split = 'test'").select("source", "block_id")


def q_split_train(spark, sf_dir):
    return split_blocks(spark, sf_dir).where("split = 'train'").select("source", "block_id")


def q_cap_rows(spark, sf_dir):
    train = split_blocks(spark, sf_dir).where("split = 'train'").select("source", "block_id")
    return ds.cap(train, CAP_ROWS, SEED, ["source", "block_id"])


def mix_input(spark, sf_dir):
    d = documents(spark, sf_dir, "doc_id", "lang", "n_chars")
    return d.withColumn("grp", F.when(F.col("lang") == "en", F.lit("en")).otherwise(F.lit("other")))


def q_mix_rows(spark, sf_dir):
    return ds.mix(mix_input(spark, sf_dir), "grp", MIX_WEIGHTS, SEED, ["doc_id"]).select("doc_id", "grp")


def q_mix_tokens(spark, sf_dir):
    return ds.mix(mix_input(spark, sf_dir), "grp", MIX_WEIGHTS, SEED, ["doc_id"], unit="tokens",
                  size="n_chars").select("doc_id", "grp")


def _batch_view(b: DataFrame) -> DataFrame:
    joined = F.array_join(F.transform("input_ids", lambda a: F.array_join(a, ",")), ";")
    return b.select("batch_id", "rows", "ragged", joined.alias("ids"))


def q_batch_rows(spark, sf_dir):
    return _batch_view(ds.batch(cp_blocks(spark, sf_dir), BATCH, ["source", "block_id"]))


def q_batch_ragged(spark, sf_dir):
    blocks = cp_blocks(spark, sf_dir, remainder="keep")
    return _batch_view(ds.batch(blocks, BATCH, ["source", "block_id"], ragged="first"))


def labelled_rows(spark, sf_dir) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return documents(spark, sf_dir, "doc_id", "lang", "n_chars").join(lab, "doc_id")


def q_batch_labels(spark, sf_dir):
    """Numbers as labels; scalars, arrays and a column that some first rows lack."""
    rows = labelled_rows(spark, sf_dir).select(
        "doc_id", "lang", F.col("quality").alias("label"), (F.col("n_chars") / 8).alias("size"), F.array("n_chars", "doc_id").alias("pair"),
        F.when(F.col("lang") == "en", F.col("toxic").cast("long")).alias("maybe"))
    # a batch whose first row has the column must have it throughout: languages are batched apart
    parts = [ds.collate(rows.where(part), BATCH, ["doc_id"]).withColumn("part", F.lit(name)) for name, part in
             (("en", F.col("lang") == "en"), ("other", ~F.col("lang").eqNullSafe("en")))]
    b = parts[0].unionByName(parts[1])
    return b.select("part", "batch_id", "rows", "ragged", ids_text("labels").alias("labels"),
                    F.array_join(F.transform("size", lambda x: (x * 8).cast("long")), ",").alias("sizes"),
                    F.array_join(F.transform("pair", lambda p: F.array_join(p, ":")), ",").alias("pairs"), ids_text("maybe").alias("maybe"))


def q_batch_label_ids(spark, sf_dir):
    """Arrays as labels, and arrays of unequal length that fall back to the first row."""
    rows = labelled_rows(spark, sf_dir).select(
        "doc_id", F.array("quality", "toxic").alias("label_ids"),
        F.array_repeat(F.col("doc_id"), F.col("toxic") + 1).alias("input_ids"), "n_chars")
    b = ds.collate(rows, BATCH, ["doc_id"], ragged="first")
    pairs = lambda c: F.array_join(F.transform(c, lambda p: F.array_join(p, ":")), ",")
    return b.select("batch_id", "rows", "ragged", pairs("labels").alias("labels"), pairs("input_ids").alias("ids"),
                    ids_text("n_chars").alias("sizes"))


def q_step_report(spark, sf_dir):
    return ds.step_report(cp_blocks(spark, sf_dir), BATCH, ACCUM, BLOCK)


def q_export_shards(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    return ds.export_shards(e, SHARDS, ["vec_id"]).select("vec_id", "shard")


QUERIES.update({
    "pack_batch": q_pack_batch,
    "pack_pad": q_pack_pad,
    "concat_sources": q_concat_sources,
    "split_test": q_split_test,
    "split_train": q_split_train,
    "cap_rows": q_cap_rows,
    "mix_rows": q_mix_rows,
    "mix_tokens": q_mix_tokens,
    "batch_rows": q_batch_rows,
    "batch_ragged": q_batch_ragged,
    "batch_labels": q_batch_labels,
    "batch_label_ids": q_batch_label_ids,
    "step_report": q_step_report,
    "export_shards": q_export_shards,
})


# --- section 2.1 / 2.2: sources, sinks, strings --------------------------------


def q_first_source(spark, sf_dir):
    return src.first_source(documents(spark, sf_dir, "doc_id", "source"))


def q_source_keys(spark, sf_dir):
    names = table(spark, sf_dir, "pages").select(url_host("url").alias("name")).distinct()
    keyed = names.withColumn("key", source_key("name"))
    n = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_names"))
    return keyed.join(n, on="key").select("name", "key", "n_names")


def question_lines(spark, sf_dir) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return b.select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
            .select("item_id", F.col("pos").cast("long").alias("pos"), "line")


def q_questions(spark, sf_dir):
    return question_lines(spark, sf_dir).select("item_id", "pos", py_strip("line").alias("question"))


def q_preview(spark, sf_dir):
    return src.preview(q_questions(spark, sf_dir), ["item_id", "pos"], 10)


def q_strip_text(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "pos", py_strip("text").alias("text"))


def q_nonblank(spark, sf_dir):
    return doc_lines(spark, sf_dir).where(~is_blank("text")).select("doc_id", "pos")


def q_cache_manifest(spark, sf_dir):
    """Lines -> blocks through the processed-data cache; the manifest is the result."""
    lines = dense_index(doc_lines(spark, sf_dir), order=["doc_id", "pos"], group=["source"],
                        bucket=[F.floor(F.col("doc_id") / LINE_BUCKET_DOCS)], idx_col="line_no") \
        .select("source", "line_no", "text")

    def build(todo):
        return pack(todo, block=BLOCK, order=["line_no"], tokenise=tokenise_codepoint, size=codepoint_size("text"))

    root = scratch_path(spark, "cache")
    _, manifest = materialise(lines, build, root, BLOCK, "codepoint-v1")
    return manifest.select("source", "block_size", "tokenizer_fp", "rows")


QUERIES.update({
    "first_source": q_first_source,
    "source_keys": q_source_keys,
    "questions": q_questions,
    "preview": q_preview,
    "strip_text": q_strip_text,
    "nonblank": q_nonblank,
    "cache_manifest": q_cache_manifest,
})


# --- section 2.3: vocabulary ------------------------------------------------------


VOCAB_SIZE = 5000
SUB_VOCAB = 3000
MAX_LEN = 4096
EXPECTED_VOCAB = 56724


def doc_vocab(spark, sf_dir) -> DataFrame:
    return tk.word_vocab(documents(spark, sf_dir, "text"), VOCAB_SIZE)


def q_tokenise_word(spark, sf_dir):
    d = documents(spark, sf_dir, "doc_id", "source", "text")
    t = tk.tokenise_word(d, doc_vocab(spark, sf_dir))
    return t.select("doc_id", "source", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_text().alias("ids"))


def q_decode_roundtrip(spark, sf_dir):
    dec = tk.decode_codepoint_arrow(cp_tokens(spark, sf_dir).select("doc_id", "input_ids"))
    return dec.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def q_decode_words(spark, sf_dir):
    d = documents(spark, sf_dir, "doc_id", "text")
    v = doc_vocab(spark, sf_dir)
    return tk.decode_word(tk.tokenise_word(d, v), v).select("doc_id", "text")


def q_overlong(spark, sf_dir):
    return tk.overlong(cp_tokens(spark, sf_dir), MAX_LEN)


def lang_vocabs(spark, sf_dir):
    d = documents(spark, sf_dir, "lang", "text")
    base = tk.word_vocab(d.where(F.col("lang") == "en"), SUB_VOCAB)
    new = tk.word_vocab(d.where(F.col("lang") != "en"), SUB_VOCAB)
    return base, new


def q_extend_vocab(spark, sf_dir):
    base, new = lang_vocabs(spark, sf_dir)
    return vc.extend_vocab(base, new).select("id", "piece")


def q_check_vocab(spark, sf_dir):
    base, new = lang_vocabs(spark, sf_dir)
    return vc.check_vocab(vc.extend_vocab(base, new), EXPECTED_VOCAB)


def q_length_reduction(spark, sf_dir):
    d = documents(spark, sf_dir, "doc_id", "lang", "text")
    a = tk.tokenise_codepoint(d, bos=None, eos=None)
    b = tk.tokenise_word(d.select("doc_id", "text"), doc_vocab(spark, sf_dir), bos=False, eos=False)
    return vc.compare_lengths(a, b, "doc_id", "lang")


def q_token_lookup(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.explode(tk.split_words("text")).alias("piece")).distinct()
    return tk.token_ids(b, doc_vocab(spark, sf_dir)).select("piece", "id")


def q_drop_special(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    t = tk.tokenise_word(b, doc_vocab(spark, sf_dir))
    return t.select("item_id", F.array_join(drop_special("input_ids", [1, 2]), ",").alias("ids"))


QUERIES.update({
    "tokenise_word": q_tokenise_word,
    "decode_roundtrip": q_decode_roundtrip,
    "decode_words": q_decode_words,
    "overlong": q_overlong,
    "extend_vocab": q_extend_vocab,
    "check_vocab": q_check_vocab,
    "length_reduction": q_length_reduction,
    "token_lookup": q_token_lookup,
    "drop_special": q_drop_special,
})


# --- section 2.5: evaluation -------------------------------------------------------


MAX_EVAL = 100


def scored_test(spark, sf_dir, by=()):
    s = split_blocks(spark, sf_dir)
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    pairs, model, v = ev.fit_bigram(train)
    return ev.score_bigram(test, pairs, model, v, by=by)


def q_bigram_nll(spark, sf_dir):
    out = ev.summarise(scored_test(spark, sf_dir, by=["source"]), by=["source"])
    return out.select("source", "tokens", F.round("eval_loss", 6).alias("nll"))


def q_token_accuracy(spark, sf_dir):
    out = ev.summarise(scored_test(spark, sf_dir))
    return out.select("tokens", F.round("accuracy", 6).alias("accuracy"))


def q_perplexity(spark, sf_dir):
    out = ev.summarise(scored_test(spark, sf_dir))
    return out.select("tokens", F.round("eval_loss", 6).alias("eval_loss"),
                      F.round("perplexity", 4).alias("perplexity"))


def q_metric_rollup(spark, sf_dir):
    out = ev.summarise(scored_test(spark, sf_dir, by=["source"]), by=["source"], rollup=True)
    return out.select("source", "tokens", F.round("accuracy", 6).alias("accuracy"),
                      F.round("perplexity", 4).alias("perplexity"))


def labelled(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    d = documents(spark, sf_dir, "doc_id", "n_chars")
    return lab.join(d, "doc_id").select("doc_id", F.col("quality").alias("pred"),
                                        (1 - F.col("toxic")).alias("ref"), "n_chars")


def q_accuracy_count(spark, sf_dir):
    return ev.accuracy(labelled(spark, sf_dir), "pred", "ref", normalize=False)


def q_accuracy_weighted(spark, sf_dir):
    a = ev.accuracy(labelled(spark, sf_dir), "pred", "ref", weight="n_chars")
    return a.select("n", F.round("accuracy", 6).alias("accuracy"))


def q_sample_counts(spark, sf_dir):
    s = split_blocks(spark, sf_dir)
    return ds.sample_counts(s.where("split = 'train'"), "train", None).unionByName(
        ds.sample_counts(s.where("split = 'test'"), "eval", MAX_EVAL))


def q_argmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", argmax("embedding").alias("argmax"))


def q_label_typing(spark, sf_dir):
    return label_typing(table(spark, sf_dir, "labels"), ["quality", "toxic"]).unionByName(
        label_typing(table(spark, sf_dir, "events"), ["value"]))


def q_vector_bytes(spark, sf_dir):
    return ev.vector_bytes(table(spark, sf_dir, "embeddings"), by=["label"])


QUERIES.update({
    "bigram_nll": q_bigram_nll,
    "token_accuracy": q_token_accuracy,
    "perplexity": q_perplexity,
    "metric_rollup": q_metric_rollup,
    "accuracy_count": q_accuracy_count,
    "accuracy_weighted": q_accuracy_weighted,
    "sample_counts": q_sample_counts,
    "argmax": q_argmax,
    "label_typing": q_label_typing,
    "vector_bytes": q_vector_bytes,
})


# --- section 2.2 / 2.6: prompts, answers, inference -----------------------------


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def q_render_prompt(spark, sf_dir):
    return q_questions(spark, sf_dir).select("item_id", "pos", render_prompt("question").alias("prompt"))


def q_render_chat(spark, sf_dir):
    return infer.render_chat(conversations(spark, sf_dir))


def q_answer_second(spark, sf_dir):
    chat = infer.render_chat(conversations(spark, sf_dir))
    return chat.select("conv_id", extract_answer(drop_markers("text"), "second").alias("answer"))


def q_answer_last(spark, sf_dir):
    chat = infer.render_chat(conversations(spark, sf_dir))
    return chat.select("conv_id", extract_answer(drop_markers("text"), "last").alias("answer"))


def q_cut_at_stop(spark, sf_dir):
    chat = infer.render_chat(conversations(spark, sf_dir))
    return chat.select("conv_id", cut_at_stop("text").alias("text"))


def q_turn_pairs(spark, sf_dir):
    return infer.turn_pairs(conversations(spark, sf_dir), dense=False)


def q_prediction_record(spark, sf_dir):
    pairs = infer.turn_pairs(conversations(spark, sf_dir), dense=False)
    pairs = dense_index(pairs, order=["conv_id", "turn"])
    pairs = pairs.withColumn("prompt", render_prompt("question"))
    return infer.prediction_record(pairs, input="prompt")


def q_batch_generate(spark, sf_dir):
    q = dense_index(q_questions(spark, sf_dir), order=["item_id", "pos"]).select("idx", "question")
    return infer.answer_pipeline(q, infer.stub_model)


QUERIES.update({
    "render_prompt": q_render_prompt,
    "render_chat": q_render_chat,
    "answer_second": q_answer_second,
    "answer_last": q_answer_last,
    "cut_at_stop": q_cut_at_stop,
    "turn_pairs": q_turn_pairs,
    "prediction_record": q_prediction_record,
    "batch_generate": q_batch_generate,
})


# --- section 2.7 / 2.8: keyed merges, name filter ---------------------------------


LOW_RANK = 4
ALPHA = 2.0
NAME_PATTERN = r"https?://m\."


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def patch_table(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    doubled = e.where(F.col("label") == 3).select(
        "vec_id", F.transform("embedding", lambda x: x * 2).alias("embedding"), "label")
    foreign = e.where(F.col("label") == 4).select(
        (F.col("vec_id") + 1_000_000).alias("vec_id"), "embedding", "label")
    return doubled.unionByName(foreign)


def exploded(df, col="embedding"):
    return df.select("vec_id", F.posexplode(col).alias("pos", "v")).select(
        "vec_id", F.col("pos").cast("int").alias("pos"), F.round(F.col("v").cast("double"), 6).alias("value"))


def q_override(spark, sf_dir):
    out = keyed.override(embeddings(spark, sf_dir), patch_table(spark, sf_dir), ["vec_id"], ["embedding"])
    return exploded(out)


def q_override_fields(spark, sf_dir):
    out = keyed.override_fields(embeddings(spark, sf_dir), patch_table(spark, sf_dir), ["vec_id"],
                                {"label": F.col("label") + 100})
    return out.select("vec_id", "label", F.round(F.element_at("embedding", 1).cast("double"), 6).alias("e0"))


def q_last_wins(spark, sf_dir):
    ev_ = table(spark, sf_dir, "events")
    parts = (ev_.select(F.concat(F.lit("L"), F.hour("ts").cast("string"), F.lit("-part.00")).alias("part"),
                        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("key"))
                .groupBy("part", "key").agg(F.count(F.lit(1)).alias("value")))
    return keyed.last_wins(parts, ["key"], "part", ["value"])


def _low_rank(spark, sf_dir, r):
    e = embeddings(spark, sf_dir)
    a = keyed.class_means(e, list(range(r)))
    return keyed.apply_low_rank(e.select("vec_id", "embedding"), a, a.T, ALPHA, r)


def q_low_rank(spark, sf_dir):
    return exploded(_low_rank(spark, sf_dir, LOW_RANK))


def q_low_rank_r1(spark, sf_dir):
    return exploded(_low_rank(spark, sf_dir, 1))


def q_name_filter(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.where(keyed.name_filter("url", NAME_PATTERN))


QUERIES.update({
    "override": q_override,
    "override_fields": q_override_fields,
    "last_wins": q_last_wins,
    "low_rank": q_low_rank,
    "low_rank_r1": q_low_rank_r1,
    "name_filter": q_name_filter,
})


# --- section 2.9: streaming ---------------------------------------------------------


def q_score_stream(spark, sf_dir):
    """User turns as JSON request files -> request stream -> answers read back."""
    root = scratch_path(spark, "requests")
    conv = conversations(spark, sf_dir).where(F.col("role") == "user")
    conv.select(F.to_json(F.struct("conv_id", "turn", F.col("text").alias("query"))).alias("value")) \
        .write.text(f"{root}/in")
    q = st.score_stream(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", infer.stub_model)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.get_json_object("output", "$.conv_id").cast("long").alias("conv_id"),
                      F.get_json_object("output", "$.turn").cast("long").alias("turn"),
                      "query", F.get_json_object("output", "$.output").alias("output"), "error")


QUERIES.update({
    "score_stream": q_score_stream,
})


# --- section 2.3: unigram --------------------------------------------------------


UNIGRAM_SIZE = 2000


def unigram_vocab(spark, sf_dir):
    return ug.train_unigram(documents(spark, sf_dir, "text"), UNIGRAM_SIZE)


def q_train_unigram(spark, sf_dir):
    return unigram_vocab(spark, sf_dir)


def q_tokenise_unigram(spark, sf_dir):
    v = unigram_vocab(spark, sf_dir)
    t = ug.tokenise_unigram(documents(spark, sf_dir, "doc_id", "source", "text"), v)
    return t.select("doc_id", "source", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_text().alias("ids"))


def q_length_reduction_unigram(spark, sf_dir):
    """T8 with a learned subword vocabulary: code points vs Unigram pieces."""
    d = documents(spark, sf_dir, "doc_id", "lang", "text")
    a = tk.tokenise_codepoint(d, bos=None, eos=None)
    b = ug.tokenise_unigram(d.select("doc_id", "text"), unigram_vocab(spark, sf_dir), bos=False, eos=False)
    return vc.compare_lengths(a, b, "doc_id", "lang")


def q_decode_unigram(spark, sf_dir):
    v = unigram_vocab(spark, sf_dir)
    ids = ug.tokenise_unigram(documents(spark, sf_dir, "doc_id", "text"), v).select("doc_id", "input_ids")
    return ug.decode_unigram_table(ids, v)


QUERIES.update({
    "decode_unigram": q_decode_unigram,
    "train_unigram": q_train_unigram,
    "tokenise_unigram": q_tokenise_unigram,
    "length_reduction_unigram": q_length_reduction_unigram,
})
