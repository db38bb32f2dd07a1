"""Preference pairs as one prompt and two masked completions, with SQL functions only.

The turns that the chosen and the rejected conversation share from the start
are rendered once as the prompt; what follows in either is its completion, in
which the mask marks what a model is to learn: the assistant's words and the
sign that ends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Signs around each turn. Fixed values of the format.
HEAD, BREAK, END = "<|", "|>\n", "<|end|>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(BREAK))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END + "\n"))), "")


def _mask(turns: Column, learned: str) -> Column:
    """start:end of what is learned, in characters of the rendered turns."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + F.lit(len(END))
        spans = F.when(t["role"] == learned, F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(done["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, first, step, lambda done: done["spans"])


def format_preferences(turns: DataFrame, pair: Column, chosen: Column, turn: str = "turn", role: str = "role", text: str = "text", learned: str = "assistant") -> DataFrame:
    """One row for each pair that has turns on both sides.

    pair names the pair a row belongs to, chosen says on which side; rows where
    either is null are left out. Turns are in the order of their number, null
    first, then of role and text, so repeated rows are repeated turns. A null
    role or text counts as empty. Turns are equal if role and text are. An
    empty table gives an empty result; other columns are ignored, whatever
    their names. A conversation is gathered whole, with texts of any length.
    Returns pair_id, n_common, prompt, chosen, rejected and, for both
    completions, the spans to learn.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = turns.select(pair.alias("pair_id"), chosen.alias("side"), one.alias("t")).where("pair_id is not null and side is not null")
    both = rows.groupBy("pair_id").agg(F.sort_array(F.collect_list(F.when(F.col("side"), F.col("t")))).alias("a"), F.sort_array(F.collect_list(F.when(~F.col("side"), F.col("t")))).alias("b")).where("size(a) > 0 and size(b) > 0")
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", 1, shorter), F.slice("b", 1, shorter), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differ = F.array_position(same, False)
    n = F.when(differ == 0, shorter).otherwise(differ - 1).cast("int")
    split = both.withColumn("n", n).select("pair_id", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), *(F.slice(c, F.col("n") + 1, F.size(c)).alias(c) for c in "ab"))
    return split.select(
        "pair_id", F.col("n").cast("long").alias("n_common"), _render(F.col("p")).alias("prompt"),
        _render(F.col("a")).alias("chosen"), _render(F.col("b")).alias("rejected"),
        _mask(F.col("a"), learned).alias("chosen_spans"), _mask(F.col("b"), learned).alias("rejected_spans"),
    )
