"""Chat formatting in budgeted windows, in DataFrame functions only.

Each turn becomes `### role: text </turn>` and a line end. In roles and texts backslash, #, < (and : in roles)
are written as a backslash and a letter, so no control string can occur inside one, and unescaping restores
the text. A window shows the conversation's system turn, the last `history` turns before its span where they fit
the history budget, and the span. What the budget leaves beside the system turn and the history budget is the
room for spans. Prefix sums of turn tokens choose spans aligned to turns: turns that lie wholly within one
stretch of `room` tokens form a span, a turn that crosses a border stands alone, so no window exceeds the budget
unless its span is one turn. The loss mask covers the assistant texts of the span alone, so repeated targets
are masked.

Prefix sums come in two levels, within blocks of BLOCK turns and over the blocks' sums, so that a conversation
with a large share of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BUDGET, HISTORY_TURNS, HISTORY_TOKENS, BLOCK = 1024, 2, 256, 1024
START, END = "### ", " </turn>\n"


def escaped(column, role: bool = False):
    out = F.replace(F.replace(F.replace(column, F.lit("\\"), F.lit("\\s")), F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescaped(column):
    out = F.replace(F.replace(F.replace(column, F.lit("\\c"), F.lit(":")), F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def tokens(text):
    """A turn's share of the budget: a quarter of its characters, and its frame."""
    return (F.ceil(F.char_length(text) / 4) + 8).cast("long")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS,
            block: int = BLOCK) -> DataFrame:
    """Rows (conv_id, window, formatted, n_repeated, loss array<struct<start, length>>).

    window is the place of the span's first turn; n_repeated counts the leading turns shown again; loss has
    code points from 0. Turns are ordered by turn, then role and text, null turns first. Null roles and texts
    are empty; rows without conv_id form one conversation; repeated rows are turns of their own; an empty table
    gives no rows; other columns are ignored.
    """
    rows = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 60))).cast("long")).withColumn("size", tokens(F.col("text")))
    sums = rows.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("size").alias("s"), F.min(F.when(F.col("role") == "system", F.struct("turn", "text", "size"))).alias("system"))
    whole = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    room = F.greatest(budget - history_tokens - F.coalesce(F.min("system").over(whole)["size"], F.lit(0)), F.lit(1))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s0"), room.alias("room"))
    within = W.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("i", F.row_number().over(within) - 1).withColumn("upto", F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)))
    placed = placed.join(sums, ["conv", "block"]).withColumn("place", F.col("i") + F.col("n0")).withColumn("upto", F.col("upto") + F.col("s0"))
    first, last = F.floor((F.col("upto") - F.col("size")) / F.col("room")), F.floor((F.col("upto") - 1) / F.col("room"))
    turns = placed.select(
        "conv_id", "conv", "place", "role", "size",
        F.when(first == last, first * 2).otherwise(first * 2 + 1).alias("span"),
        F.concat(F.lit(START), escaped(F.col("role"), True), F.lit(": ")).alias("head"), escaped(F.col("text")).alias("body"))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(END)))

    system = turns.where("role = 'system'").groupBy("conv").agg(F.min_by(F.struct("place", "piece"), "place").alias("system"))
    spans = turns.groupBy("conv", "span").agg(
        F.first("conv_id").alias("conv_id"), F.min("place").alias("window"),
        F.array_sort(F.collect_list(F.struct("place", "role", F.char_length("head").alias("head"), F.char_length("body").alias("body"), "piece"))).alias("own"))
    wanted = spans.select("conv", "window", F.explode(F.sequence(F.col("window") - history, F.col("window") - 1)).alias("place"))
    before = wanted.join(turns.select("conv", "place", "piece", "size", F.col("role").alias("r")), ["conv", "place"]).where("r <> 'system'")
    before = before.groupBy("conv", "window").agg(F.array_sort(F.collect_list(F.struct((-F.col("place")).alias("back"), "size", "piece"))).alias("past"))
    fit = F.filter(F.transform("past", lambda p, k: F.struct(
        p["piece"].alias("piece"), F.aggregate(F.slice(F.col("past"), 1, k + 1), F.lit(0).cast("long"), lambda n, q: n + q["size"]).alias("upto"))), lambda p: p["upto"] <= history_tokens)
    joined = spans.join(before, ["conv", "window"], "left").join(system, "conv", "left")
    shown_system = F.col("system").isNotNull() & (F.col("system.place") < F.col("window"))
    shown = joined.select(
        "conv_id", "window", "own",
        F.concat(F.when(shown_system, F.array("system.piece")).otherwise(F.array().cast("array<string>")),
                 F.reverse(F.transform(F.coalesce(fit, F.array().cast("array<struct<piece:string,upto:bigint>>")), lambda p: p["piece"]))).alias("repeated"))
    shown = shown.withColumn("lead", F.array_join("repeated", ""))
    zero = F.struct(F.char_length("lead").cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss"))
    folded = F.aggregate("own", zero, lambda acc, t: F.struct(
        (acc["at"] + F.char_length(t["piece"])).cast("long").alias("at"),
        F.when(t["role"] == "assistant", F.concat(acc["loss"], F.array(F.struct((acc["at"] + t["head"]).cast("long").alias("start"), t["body"].cast("long").alias("length")))))
        .otherwise(acc["loss"]).alias("loss")))
    return shown.select("conv_id", "window", F.concat("lead", F.array_join(F.transform("own", lambda t: t["piece"]), "")).alias("formatted"),
                        F.size("repeated").alias("n_repeated"), folded["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Rows (conv_id, window, turns array<struct<role, text>>, targets array<string>, formatted), from windows()."""
    parts = F.split("formatted", END)
    own = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    turns = F.transform(own, lambda p: F.struct(
        unescaped(F.substring_index(F.substr(p, F.lit(len(START) + 1)), ": ", 1)).alias("role"),
        unescaped(F.substr(p, F.instr(p, ": ") + 2)).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "window", turns.alias("turns"), targets.alias("targets"), "formatted")


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns, read back from the operator's windows."""
    back = read_back(windows(conversations)).select(
        "conv_id", "window", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"), F.char_length("formatted").alias("chars"))
    whole = back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    turns, loss = (F.array_join(F.col("w")[k], "") for k in ("turns", "targets"))
    return whole.select("conv_id", "n_turns", F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows")


def with_test_conversation(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table and conversation -7, whose texts hold control strings."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return conversations.select(*[F.col(c).cast(t).alias(c) for c, t in extra.dtypes]).unionByName(extra)
