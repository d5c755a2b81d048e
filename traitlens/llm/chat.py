"""Chat formatting (operator 10): budgeted windows over conversations, in DataFrame functions only.

A conversation's turns are ordered by ``turn`` (ties: role, the text's first 32 characters, its hash).  Prefix sums of the turns' token counts (at least 1
a turn) cut them into windows: a window takes new turns while their tokens fit its budget (a longer turn gets a window of
its own; turns are never cut).  Every later window starts with the conversation's system turn and a limited history, the
last turns before its first new one.  Repeated turns are masked, so each assistant text is a target exactly once.

A window is ``<s>`` and its turns, each ``[INST]role[/INST]text</s>``.  Inside roles and texts a backslash is doubled and
put after the first character of a control string; dropping it again restores the text.  Targets are the escaped texts
of new assistant turns, as (start, end) code point offsets into the window.

No conversation is ever in one row or one task while it is formatted.  Rows are dealt by ranges of (conversation, turn); a
range sums its own tokens, and the sums of the ranges before it are added.  ``SEGMENT`` budgets of tokens by prefix sum
are a segment, in which windows are packed one after the other; a window also ends with its segment.  The history of a
segment's first window comes from the segments before, two rows at most, by a join.  A group is thus bounded by
the budget and the length of a turn, whatever the conversation.  ``digests`` alone needs a conversation's text together.

Defined results: null texts and roles are empty; rows without conv_id are one conversation with null conv_id; a null
turn comes first; repeated rows are repeated turns; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BUDGET = 1024
HISTORY_TOKENS = 192
HISTORY_TURNS = 2
SEGMENT = 8  # budgets of a segment

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
_BEFORE_CONTROL = r"(<(?=/?s>)|\[(?=/?INST\]))"
_TOKENS = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _BEFORE_CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place and prefix sum in the conversation, and per (range, conversation) the system turn, if any."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    rows = rows.select(
        F.coalesce("conv", F.lit("")).alias("conv"), "turn", "role", "text",
        F.greatest(F.regexp_count("text", F.lit(_TOKENS)), F.lit(1)).cast("long").alias("tokens"), F.monotonically_increasing_id().alias("tie"),
    )
    # Ranges by the start of the text and its hash, so that their sample stays small.
    rows = rows.withColumns({"opening": F.substring("text", 1, 32), "hash": F.xxhash64("text")})
    place = ["turn", "role", "opening", "hash", "tie"]
    ranged = cut_lineage(rows.repartitionByRange("conv", *place).withColumn("part", F.spark_partition_id()), "turns")

    own = F.struct(*place[:-1], "text", "tokens")
    parts = ranged.groupBy("part", "conv").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"), F.min(own).alias("first"))
    order = Window.partitionBy("conv").orderBy("part")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("first")
    system = F.struct(first["tokens"].alias("tokens"), _head(first["role"]).alias("head"), escape(first["text"]).alias("body"))
    offsets = cut_lineage(
        parts.select(
            "part", "conv", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum_before"),
            F.first(F.when(first["role"] == "system", system)).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("system"),
        ),
        "offsets",
    )
    here = Window.partitionBy("part", "conv").orderBy(*place)
    turns = (
        ranged.select("part", "conv", "role", "text", "tokens", F.row_number().over(here).alias("at"), F.sum("tokens").over(here.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
        .join(offsets.select("part", "conv", "n_before", "sum_before", F.col("system.tokens").alias("system_tokens")), ["part", "conv"])
        .select("part", "conv", "system_tokens", (F.col("at") + F.col("n_before")).alias("at"), (F.col("upto") + F.col("sum_before")).alias("upto"), "tokens",
                (F.col("role") == "assistant").alias("target"), _head(F.col("role")).alias("head"), escape(F.col("text")).alias("body"))
    )
    return turns, offsets.select("part", "conv", "system").where("system is not null")


def _head(role: Column) -> Column:
    return F.concat(F.lit("[INST]"), escape(role), F.lit("[/INST]"))


def windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """One row per window: conv_id, window (the number of its first new turn), formatted, targets (code point spans), n_repeated (leading repeated turns)."""
    turns, systems = _turns(conversations)
    span = SEGMENT * budget
    one = F.struct("at", "upto", "tokens", "target", "head", "body")
    segments = cut_lineage(
        turns.groupBy("conv", F.expr(f"(upto - tokens) div {span}").alias("segment"))
        .agg(F.array_sort(F.collect_list(one)).alias("turns"), F.min("part").alias("part"), F.max("system_tokens").alias("system_tokens"))
        .select("conv", "part", F.expr("turns[0].at").alias("first"), "turns", F.greatest(F.lit(budget - history_tokens) - F.coalesce("system_tokens", F.lit(0)), F.lit(1)).alias("room")),
        "segments",
    )
    # The turns before a segment are among the last of the segments before it.
    tails = segments.select("conv", F.explode(F.expr(f"slice(turns, greatest(size(turns) - {history_turns - 1}, 1), {history_turns})")).alias("t")).select("conv", F.col("t.at").alias("at"), "t")
    wanted = segments.where("first > 1").select("conv", "first", F.explode(F.sequence(F.greatest(F.col("first") - history_turns, F.lit(1)), F.col("first") - 1)).alias("at"))
    past = wanted.join(tails, ["conv", "at"]).groupBy("conv", "first").agg(F.array_sort(F.collect_list("t")).alias("past"))

    # First turn of each window: a new one starts where the prefix sum since the last start would pass the room.
    starts = F.expr(
        "aggregate(turns, named_struct('s', cast(array() as array<bigint>), 'b', 0L), (a, t) -> "
        "if(size(a.s) = 0 or t.upto - a.b > room, named_struct('s', array_append(a.s, t.at), 'b', t.upto - t.tokens), a), a -> a.s)"
    )
    none = F.expr("slice(turns, 1, 0)")
    cut = (
        segments.join(past, ["conv", "first"], "left").join(systems, ["part", "conv"], "left")
        .select("conv", "first", "system", F.concat(F.coalesce("past", none), "turns").alias("known"), F.coalesce(F.size("past"), F.lit(0)).alias("n_past"), F.size("turns").alias("n"), starts.alias("starts"))
        .select("conv", "first", "system", "known", "n_past", "n", "starts", F.posexplode("starts").alias("i", "window"))
        .withColumn("start", (F.col("window") - F.col("first")).cast("int") + 1 + F.col("n_past"))
        .withColumn("end", F.when(F.col("i") + 1 < F.size("starts"), F.expr("cast(starts[i + 1] - first as int)") + 1 + F.col("n_past")).otherwise(F.col("n") + F.col("n_past") + 1))
    )
    piece = lambda t: F.concat(t["head"], t["body"], F.lit("</s>"))
    again = F.expr(
        f"filter(slice(known, greatest(start - {history_turns}, 1), start - greatest(start - {history_turns}, 1)), "
        f"t -> known[start - 1].upto - known[start - 1].tokens - (t.upto - t.tokens) <= {history_tokens} and not (t.at = 1 and system is not null))"
    )
    led = F.concat(F.when(F.col("system").isNotNull(), F.array(piece(F.col("system")))).otherwise(F.array().cast("array<string>")), F.transform(again, piece))
    shown = cut.select("conv", "window", F.expr("slice(known, start, end - start)").alias("new"), F.when(F.col("window") > 1, led).otherwise(F.array().cast("array<string>")).alias("again"))
    # Offsets by the prefix sum of the lengths, from the end of the repeated part.
    spans = F.expr(
        "aggregate(new, named_struct('at', cast(length(lead) as bigint), 'spans', cast(array() as array<struct<start: bigint, end: bigint>>)), "
        "(a, t) -> named_struct('at', a.at + length(t.head) + length(t.body) + 4, 'spans', "
        "if(t.target, array_append(a.spans, named_struct('start', a.at + length(t.head), 'end', a.at + length(t.head) + length(t.body))), a.spans)), "
        "a -> a.spans)"
    )
    conv_id = F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id")
    return (
        shown.withColumn("lead", F.concat(F.lit("<s>"), F.array_join("again", "")))
        .select(conv_id, "window", F.concat("lead", F.array_join(F.transform("new", piece), "")).alias("formatted"), spans.alias("targets"), F.size("again").alias("n_repeated"))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and targets read from the windows' text: conv_id, n_turns, turns_text, loss_text, formatted_chars."""
    parts = F.expr("slice(split(substring(formatted, 4), '</s>'), n_repeated + 1, size(split(substring(formatted, 4), '</s>')) - 1 - n_repeated)")
    turn = lambda p: F.concat(
        unescape(F.substring_index(F.substring(p, 7, 2147483647), "[/INST]", 1)), F.lit("\n"),
        unescape(F.substring(p, F.locate("[/INST]", p) + 7, F.length(p))), F.lit("\n"),
    )
    target = lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return (
        formatted.withColumn("parts", parts)
        .select(
            "conv_id",
            F.struct(
                "window",
                F.size("parts").cast("long").alias("n"),
                F.array_join(F.transform("parts", turn), "").alias("turns"),
                F.array_join(F.transform("targets", target), "").alias("loss"),
                F.length("formatted").cast("long").alias("chars"),
            ).alias("w"),
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("w")).alias("w"))
        .select(
            "conv_id",
            F.expr("aggregate(w, 0L, (a, x) -> a + x.n)").alias("n_turns"),
            F.array_join(F.col("w.turns"), "").alias("turns_text"),
            F.array_join(F.col("w.loss"), "").alias("loss_text"),
            F.expr("aggregate(w, 0L, (a, x) -> a + x.chars)").alias("formatted_chars"),
            F.size("w").cast("long").alias("n_windows"),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns from the windows."""
    return read_back(formatted).select(
        "conv_id",
        "n_turns",
        F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
