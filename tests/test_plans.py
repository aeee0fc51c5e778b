"""End-to-end flows A (corpus -> cached blocks -> split) and B (questions ->
predictions), plus the sinks' round trips (S5, S6, S9, S11)."""
import json
import os

from pyspark.sql import functions as F

from quire.operators.evaluate import metrics_long
from quire.operators.infer import stub_model
from quire.plans.predict import predict_file
from quire.plans.prepare import prepare_blocks, split_and_cap
from quire.sources.sinks import read_metrics, read_predictions, write_metrics


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_prepare_cache_and_split(spark, tmp_path):
    corpus, cache = str(tmp_path / "corpus"), str(tmp_path / "cache")
    _w(f"{corpus}/one.txt", "".join(f"ཀ་ཁ་ line {i}\n" for i in range(200)))
    _w(f"{corpus}/two.txt", "short\n")
    blocks, manifest = prepare_blocks(spark, corpus, cache, block=32)
    m1 = {r.source: (r.content_fp, r.rows) for r in manifest.collect()}
    assert set(m1) == {"one", "two"} and m1["two"][1] == 1
    n1 = blocks.count()
    # unchanged corpus: served from the cache, same manifest
    _, manifest2 = prepare_blocks(spark, corpus, cache, block=32)
    assert {r.source: (r.content_fp, r.rows) for r in manifest2.collect()} == m1
    # changed source is rebuilt, the other kept
    _w(f"{corpus}/two.txt", "short\nand longer now with more text than one block of tokens\n")
    blocks3, manifest3 = prepare_blocks(spark, corpus, cache, block=32)
    m3 = {r.source: (r.content_fp, r.rows) for r in manifest3.collect()}
    assert m3["one"] == m1["one"] and m3["two"] != m1["two"]
    assert blocks3.count() == n1 - 1 + m3["two"][1]
    # another block size is a separate cache entry; overwrite rebuilds
    b64, _ = prepare_blocks(spark, corpus, cache, block=64, overwrite_cache=True)
    assert set(b64.select("source").distinct().toPandas()["source"]) == {"one", "two"}
    train, test = split_and_cap(blocks3, 0.1, 42, max_eval=2)
    assert test.count() == 2 and train.count() + 2 <= blocks3.count()


def test_predict_file_round_trip(spark, tmp_path):
    q = str(tmp_path / "q.txt")
    _w(q, "为什么要保护环境？\n  second question  \n")
    out = str(tmp_path / "pred")
    predict_file(spark, q, out, stub_model)
    rows = sorted(read_predictions(spark, out).collect(), key=lambda r: r.idx)
    assert [r.Input for r in rows] == ["为什么要保护环境？", "second question"]
    assert rows[1].Output == "question second"
    raw = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".json"))
    assert "为什么" in raw                                   # non-ASCII written as is


def test_metrics_sink(spark, tmp_path):
    wide = spark.createDataFrame([(0.5, 12.0)], "eval_loss double, perplexity double")
    write_metrics(metrics_long(wide, "eval", ["eval_loss", "perplexity"]), str(tmp_path / "m"))
    got = {(r.phase, r.metric): r.value for r in read_metrics(spark, str(tmp_path / "m")).collect()}
    assert got == {("eval", "eval_loss"): 0.5, ("eval", "perplexity"): 12.0}


def test_prediction_input_modes(spark):
    from quire.operators.infer import answer_pipeline
    q = spark.createDataFrame([(0, "why?")], "idx bigint, question string")
    raw = answer_pipeline(q, stub_model, input="raw").first()
    prompt = answer_pipeline(q, stub_model, input="prompt").first()
    assert raw.Input == "why?" and prompt.Input.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")
    assert raw.Output == prompt.Output == "why?"
    plain = answer_pipeline(q, stub_model, with_prompt=False).first()
    assert plain.Output.endswith("why?")


def test_validation_files_replace_split(spark, tmp_path):
    from quire.plans.prepare import with_validation_files
    corpus, cache = str(tmp_path / "corpus"), str(tmp_path / "cache")
    _w(f"{corpus}/a.txt", "".join(f"train line {i}\n" for i in range(50)))
    _w(str(tmp_path / "val" / "v.txt"), "".join(f"valid {i}\n" for i in range(30)))
    train, test = with_validation_files(spark, corpus, [str(tmp_path / "val" / "v.txt")], cache, block=16)
    assert {r.source for r in train.collect()} == {"a"}
    assert {r.source for r in test.collect()} == {"v"} and test.count() > 0
