"""Batch inference and dialogue data.

``generate`` runs a user model over a column in Arrow batches with
``mapInPandas``; ``make_model()`` is called once per task, so a heavy model
loads once per partition, never per row. The model is any callable from a
list of prompts to a list of decoded outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ship_package
from quire.functions.text import (DEFAULT_SYSTEM_PROMPT, cut_at_stop, extract_answer,
                                  render_prompt, render_turn)

Model = Callable[[list[str]], list[str]]


def generate(df: DataFrame, make_model: Callable[[], Model], input_col: str = "prompt",
             output_col: str = "raw", batch_size: int = 32) -> DataFrame:
    """Add ``output_col`` = model(input) for every row (I1). Rows keep their
    other columns (``idx`` carries the pairing, I2)."""
    ship_package(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(output_col, T.StringType())])

    def run(batches):
        model = make_model()
        for pdf in batches:
            prompts = pdf[input_col].fillna("").tolist()
            outs: list[str] = []
            for i in range(0, len(prompts), batch_size):
                outs.extend(model(prompts[i:i + batch_size]))
            pdf[output_col] = outs
            yield pdf
    return df.mapInPandas(run, schema)


def prediction_record(df: DataFrame, input: str = "raw", question_col: str = "question",
                      prompt_col: str = "prompt", answer_col: str = "answer") -> DataFrame:
    """(idx, Input, Output) (I3). ``Input`` is the raw question or the
    rendered prompt, as the two back ends of the reference differ (Q6)."""
    if input not in ("raw", "prompt"):
        raise ValueError("input must be 'raw' or 'prompt'")
    src = question_col if input == "raw" else prompt_col
    return df.select("idx", F.col(src).alias("Input"), F.col(answer_col).alias("Output"))


def answer_pipeline(questions: DataFrame, make_model: Callable[[], Model], with_prompt: bool = True,
                    input: str = "raw", system: str = DEFAULT_SYSTEM_PROMPT, output: str = "full") -> DataFrame:
    """Question rows (idx, question) -> prediction records: render, generate,
    cut at the stop strings, extract the answer. ``output="full"``: the model
    returns prompt and answer, which is the second part (file mode);
    ``"answer"``: it returns the answer alone, which is not split."""
    if output not in ("full", "answer"):
        raise ValueError("output must be 'full' or 'answer'")
    p = questions.withColumn("prompt", render_prompt("question", system=system, with_prompt=with_prompt))
    g = generate(p, make_model, "prompt", "raw")
    ans = extract_answer(cut_at_stop("raw"), "second") if with_prompt and output == "full" else cut_at_stop("raw")
    return prediction_record(g.withColumn("answer", ans), input=input)


def turn_pairs(conv: DataFrame, dense: bool = True) -> DataFrame:
    """Single-turn pairs (I4): a user turn whose next turn, by ``turn`` order,
    is an assistant turn. With ``dense``, ``turn`` is the position (0, 1, 2,
    ...); otherwise positions come first from the bucketed index, so gaps do
    not matter. The next turn is an equi-join on (conv_id, position): a huge
    conversation spreads over many tasks, where a window would put it in one."""
    from quire.operators.index import dense_index
    at = conv.select("conv_id", "turn", "role", "text")
    at = at.withColumn("_at", F.col("turn")) if dense else dense_index(
        at, order=["turn"], group=["conv_id"], idx_col="_at")
    u = at.where(F.col("role") == "user").select("conv_id", "turn", "_at", F.col("text").alias("question"))
    a = at.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("_at") - 1).alias("_at"), F.col("text").alias("answer"))
    return u.join(a, on=["conv_id", "_at"], how="inner").drop("_at")


def render_chat(conv: DataFrame, default_system: str | None = None) -> DataFrame:
    """Whole conversation -> one training string (I5, F5): turns rendered in
    the chat format and concatenated in turn order. A turn with a role outside
    the format is an error, not a turn that silently disappears. With ``default_system``,
    conversations without a system turn get that system block first."""
    shown = render_turn("role", F.coalesce("text", F.lit("")))
    other = F.raise_error(F.concat(F.lit("no chat format for role: "), F.coalesce("role", F.lit("NULL"))))
    parts = conv.select("conv_id", "turn", F.when(shown.isNull(), other.cast("string")).otherwise(shown).alias("_t"))
    g = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "_t"))).alias("_s"),
        F.max((F.col("_t").startswith("<|start_header_id|>system")).cast("int")).alias("_has_sys"))
    text = F.array_join(F.transform("_s", lambda s: s["_t"]), "")
    if default_system is not None:
        head = render_turn(F.lit("system"), F.lit(default_system))
        text = F.when(F.col("_has_sys") == 1, text).otherwise(F.concat(head, text))
    return g.select("conv_id", text.alias("text"))


# ---------------------------------------------------------------------------
# A stub model for tests and engine measurements: answers with the words of
# the question in reverse order, as a decoder would return prompt + answer.
# ---------------------------------------------------------------------------

def stub_model() -> Model:
    def model(prompts: list[str]) -> list[str]:
        import re
        out = []
        for p in prompts:
            question = p.split("<|start_header_id|>user<|end_header_id|>\n\n")[-1].split("<|eot_id|>")[0]
            words = question.split()
            reply = " ".join(reversed(words)) + "<|eot_id|>trailing"
            out.append(re.sub(r"<\|(start_header_id|end_header_id|eot_id|begin_of_text)\|>", "", p) + reply)
        return out
    return model
