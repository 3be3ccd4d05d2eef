"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: the formatted text of all turns before it as
context, and the turn itself, whose reply alone is trainable (``loss_start`` to
``loss_end``, in code points, of ``text``). Turns after the last assistant turn go into
one closing example without a trainable part, so the output holds every turn.

The template marks a turn as ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside roles and
texts a ``~`` is doubled and the control strings get a ``~`` after their first
character; a single ``~`` therefore always marks an escape and the way back is exact.

Cases: null text and null role are empty; rows with equal turn numbers are ordered by
role and text; a null turn comes first; a null conv_id is a conversation; a
conversation without an assistant turn has the closing example only; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of this and other common chat templates: fixed values.
CONTROL = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
_CONTROL = (r"<(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)|\[(?=/?INST\])")
_BREAK = "~␤"  # a line break inside a role


def escaped(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("~"), F.lit("~~")), "(" + _CONTROL + ")", "$1~")


def unescaped(c: Column) -> Column:
    """A run of tildes halves; a single one goes."""
    return F.regexp_replace(c, "~(~?)", "$1")


def escaped_role(c: Column) -> Column:
    return F.replace(escaped(c), F.lit("\n"), F.lit(_BREAK))


def unescaped_role(c: Column) -> Column:
    return unescaped(F.regexp_replace(c, "(?<!~)((?:~~)*)" + _BREAK, "$1\n"))


def formatted_turn(turn: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(turn["role"]), F.lit("\n"), escaped(turn["text"]),
                    F.lit(END + "\n"))


def prefix_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, target, trainable, text, loss_start, loss_end): one row per example."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text")))).alias("turns"))
    conv = conv.withColumn("parts", F.transform("turns", formatted_turn)).withColumn("n", F.size("turns"))
    is_target = lambda k: (F.get("turns", k - 1)["role"] == "assistant") | (k == F.col("n"))
    rows = conv.withColumn("target", F.explode(F.filter(F.sequence(F.lit(1), F.col("n")), is_target)))
    turn = F.get("turns", F.col("target") - 1)
    body = F.length(escaped(turn["text"]))
    rows = rows.select(
        "conv_id", "target", (turn["role"] == "assistant").alias("trainable"),
        F.array_join(F.slice("parts", F.lit(1), F.col("target")), "").alias("text"), body.alias("body"))
    end = F.length("text") - len(END) - 1
    return rows.select(
        "conv_id", "target", "trainable", "text",
        F.when(F.col("trainable"), end - F.col("body")).otherwise(end).alias("loss_start"), end.alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as structs of role and text."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescaped_role(F.substring(F.substring_index(p, "\n", 1), F.lit(len(START) + 1), F.length(p))).alias("role"),
        unescaped(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text")))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, trainable text, formatted size."""
    loss = F.when(F.col("trainable"), unescaped(F.substring(
        F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))))
    conv = examples.withColumn("loss", loss).groupBy("conv_id").agg(
        F.max_by("text", "target").alias("whole"),
        F.array_sort(F.collect_list(F.struct("target", "loss"))).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
        F.count("*").cast("long").alias("n_examples"))
    conv = conv.withColumn("turns", read_turns(F.col("whole"))).withColumn(
        "loss", F.array_join(F.transform("losses", lambda x: x["loss"]), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")
