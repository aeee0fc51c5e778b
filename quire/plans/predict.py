"""Entry B of the reference: question file -> prompts -> model -> answers ->
JSON-lines predictions. One narrow plan; no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from quire.operators.infer import Model, answer_pipeline
from quire.sources.corpus import scan_questions
from quire.sources.sinks import write_predictions


def predict_file(spark: SparkSession, questions_path: str, predictions_path: str,
                 make_model: Callable[[], Model], with_prompt: bool = True, input: str = "raw") -> None:
    questions = scan_questions(spark, questions_path)
    write_predictions(answer_pipeline(questions, make_model, with_prompt=with_prompt, input=input),
                      predictions_path)
