"""Chat formatting: turn-aligned windows under a token budget, with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import prefix_sums, whole, word_count
from tradewind.session import staged

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# control strings of this and other common templates are broken by a backslash after their first character
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|<?/?SYS>>)"
MARKS = 4  # tokens that the marks of a turn count for
BLOCK = 64  # turns whose running sums are formed together


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(turns: DataFrame, budget: int = 1024, history: int = 128) -> DataFrame:
    """Windows (conv_id, window, formatted, loss_spans, repeated, n_tokens) of conversations.

    Tokens are words plus 4 a turn. Prefix sums of the tokens cut a conversation
    into cells of half of what the budget leaves beside history and system turn;
    turns that begin in one cell and are no longer than it form a window, so a
    window stays within the budget. A longer turn is a window of its own, whole.
    A first turn by `system` opens every window. The turns before a window that
    begin within `history` tokens of it are repeated in front of its new turns;
    `repeated` counts the leading repeated turns (system and history).
    `loss_spans` are (start from 1, length) in code points of the texts of new
    assistant turns in `formatted`; repeated ones are masked.

    Turns are ordered by turn (null first), role, text; null role and text count
    as empty; null conv_id is one conversation; repeated rows are turns of their
    own. No rows give no windows. Other columns are not carried.
    """
    t = turns.select(
        "conv_id",
        F.xxhash64("conv_id").alias("_c"),
        F.col("turn").cast("long").alias("turn"),
        whole(F.col("role")).alias("role"),
        whole(F.col("text")).alias("text"),
    )
    t = staged(t.withColumn("tokens", word_count(F.col("text")) + MARKS).withColumn("_one", F.lit(1).cast("long")))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    t = staged(prefix_sums(t, ["_c"], block, order, {"at": "_one", "p": "tokens"}))
    first = (F.col("at") == 0) & (F.col("role") == "system")
    system = t.where(first).select("_c", F.col("tokens").alias("s_tokens"), F.col("text").alias("s_text"))

    half = F.greatest(F.lit(1), F.floor((budget - history - F.coalesce("s_tokens", F.lit(0))) / 2))
    t = t.join(system.select("_c", "s_tokens"), "_c", "left")
    t = t.withColumn("p", F.when(first, F.lit(-1)).otherwise(F.col("p") - F.coalesce("s_tokens", F.lit(0))))
    t = t.withColumn("half", half).withColumn("long", (~first & (F.col("tokens") > F.col("half"))).cast("long"))
    t = staged(t)
    t = prefix_sums(t, ["_c"], block, order, {"longs": "long"})
    cell = F.when(F.col("p") < 0, F.lit(0)).otherwise(F.floor(F.col("p") / F.col("half")))
    run = F.when(F.col("p") < 0, F.lit(0)).otherwise(2 * F.col("longs") + F.col("long"))
    t = t.select("conv_id", "_c", "p", "role", "text", "tokens", cell.alias("cell"), run.alias("run"))
    t = staged(t)

    key = ["_c", "cell", "run"]
    spans = t.groupBy(*key).agg(F.min("p").alias("start"), F.first("conv_id").alias("conv_id"))
    reach = F.sequence(F.floor((F.col("start") - history) / history), F.floor((F.col("start") - 1) / history))
    asked = spans.where("start > 0").withColumn("hb", F.explode(reach))
    held = t.where("p >= 0").select(
        "_c", F.floor(F.col("p") / history).alias("hb"), F.col("p").alias("p0"), "role", "text", "tokens"
    )
    past = asked.join(held, ["_c", "hb"]).where((F.col("p0") < F.col("start")) & (F.col("p0") >= F.col("start") - history))
    past = past.select("conv_id", *key, F.col("p0").alias("p"), "role", "text", "tokens", F.lit(0).alias("fresh"))
    lead = spans.where("start >= 0").join(system, "_c").select(
        "conv_id", *key, F.lit(-1).cast("long").alias("p"), F.lit("system").alias("role"),
        F.col("s_text").alias("text"), F.col("s_tokens").alias("tokens"), F.lit(0).alias("fresh"),
    )
    rows = t.select("conv_id", *key, "p", "role", "text", "tokens", F.lit(1).alias("fresh")).unionByName(past).unionByName(lead)

    shown = rows.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    shown = shown.withColumn("body", escape(F.col("text")))
    shown = shown.withColumn("piece", F.concat("head", "body", F.lit(END)))
    one = F.struct(
        "p", "role", "piece", "fresh", "tokens",
        F.char_length("head").alias("head_n"), F.char_length("body").alias("body_n"), F.char_length("piece").alias("n"),
    )
    grouped = shown.groupBy(*key).agg(F.array_sort(F.collect_list(one)).alias("a"), F.first("conv_id").alias("conv_id"))
    place = F.transform(
        "a",
        lambda x, i: F.struct(
            (F.aggregate(F.slice("a", F.lit(1), i), F.lit(0), lambda s, y: s + y["n"]) + x["head_n"] + 1).alias("start"),
            x["body_n"].alias("length"),
            ((x["role"] == "assistant") & (x["fresh"] == 1)).alias("loss"),
        ),
    )
    loss = F.transform(F.filter(place, lambda x: x["loss"]), lambda x: F.struct(x["start"], x["length"]))
    return grouped.select(
        "conv_id",
        F.struct(F.col("cell"), F.col("run")).alias("window"),
        F.array_join(F.transform("a", lambda x: x["piece"]), "").alias("formatted"),
        loss.alias("loss_spans"),
        F.size(F.filter("a", lambda x: x["fresh"] == 0)).alias("repeated"),
        F.aggregate("a", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("n_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add to windows: `turns`, their new turns (role, text), and `loss_text`, the unmasked text."""
    # what stands before the first mark is empty
    pieces = F.split("formatted", r"<\|turn\|>")
    fresh = F.filter(pieces, lambda x, i: i > F.col("repeated"))
    turns = F.transform(
        fresh,
        lambda x: F.struct(
            unescape(F.substring_index(x, TEXT, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(x, TEXT, -1), END, 1)).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda x: unescape(F.substring("formatted", x["start"], x["length"])))
    return formatted.withColumns({"turns": turns, "loss_text": F.array_join(loss, "")})


def digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from its windows. A digest covers the whole
    conversation in order, so the texts of one conversation meet in one row."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    back = read_back(formatted).select(
        "conv_id", "window", said.alias("said"), F.size("turns").cast("long").alias("n"), "loss_text",
        F.char_length("formatted").cast("long").alias("chars"),
    )
    each = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "said", "loss_text"))).alias("a"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("a", lambda x: x["said"]), "")
    loss = F.array_join(F.transform("a", lambda x: x["loss_text"]), "")
    return each.select(
        "conv_id",
        "n_turns",
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_chat_windows(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return digests(windows(turns.unionByName(planted)))
