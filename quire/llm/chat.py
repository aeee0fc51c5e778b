"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one example: all preceding turns as context and
only that reply under the loss mask. A conversation whose last turn is not the
assistant's (or that has no assistant turn) gets one more example without a
target, so that no turn is lost.

Template of a turn::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside a text are escaped by one backslash more between ``<``
and ``|`` (``<|`` -> ``<\\|``, ``<\\|`` -> ``<\\\\|``), which is reversible and
leaves no ``<|`` in an escaped text. In roles ``%``, line feed and ``<`` are
percent-coded.

Defined cases: a null text or role is empty; a null conv_id is a conversation
of its own; turns with equal numbers are ordered by role, then text, null
turns first; repeated rows are repeated turns; an empty table gives no
example. Other columns of the input are ignored. A conversation is one row of
the result by definition, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    for a, b in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape_role(c: Column) -> Column:
    for a, b in (("%3C", "<"), ("%0A", "\n"), ("%25", "%")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def format_examples(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_length): the loss mask
    covers ``loss_length`` code points from the 0-based ``loss_start``; an
    example without a target has length -1."""
    rows = conversations.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"),
                 F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    ready = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))).alias("heads"),
        F.transform("turns", lambda t: escape_text(t["text"])).alias("bodies"),
        F.transform("turns", lambda t: t["role"] == F.lit(ASSISTANT)).alias("replies"))
    numbered = ready.select(
        "*", F.size("bodies").alias("n"),
        F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END))).alias("rendered"))
    picked = numbered.select(
        "conv_id", "heads", "bodies", "rendered", "n", "replies",
        F.explode(F.filter(F.sequence(F.lit(1), F.col("n")),
                           lambda i: (i == F.col("n")) | F.get("replies", i - 1))).alias("i"))
    here = F.get("replies", F.col("i") - 1)
    before = F.array_join(F.slice("rendered", 1, F.col("i") - 1), "")
    return picked.select(
        "conv_id", F.col("i").cast("long").alias("example"),
        F.concat(before, F.get("rendered", F.col("i") - 1)).alias("formatted"),
        F.when(here, F.length(before) + F.length(F.get("heads", F.col("i") - 1)))
         .otherwise(F.lit(0)).cast("long").alias("loss_start"),
        F.when(here, F.length(F.get("bodies", F.col("i") - 1))).otherwise(F.lit(-1)).cast("long").alias("loss_length"))


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, per conversation, parsed from their
    text and masks alone."""
    loss = F.expr("substring(formatted, loss_start + 1, loss_length)")
    each = examples.select(
        "conv_id", "example", F.length("formatted").cast("long").alias("chars"), "formatted",
        F.when(F.col("loss_length") >= 0,
               F.struct("example", unescape_text(loss).alias("reply"))).alias("loss"))
    per = each.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"),
        F.max_by("formatted", "example").alias("whole"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["reply"]), "").alias("loss"))
    cut = per.withColumn("marked", F.split("whole", r"<\|im_start\|>"))
    turns = F.transform(F.slice("marked", F.lit(2), F.size("marked") - 1), lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape_text(_body(t)).alias("text")))
    parsed = cut.select("conv_id", "formatted_chars", "loss", turns.alias("turns"))
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


def _body(t: Column) -> Column:
    head = F.length(F.substring_index(t, "\n", 1)) + 1
    return F.substring(t, head + 1, F.length(t) - head - len(END))
