"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import documents, hash_part, prefix_sums, word_count
from tradewind.session import staged

# the fraction is filled in steps; a document may be taken once beyond its whole repetitions in the
# first four, and further times, if the small documents of the source do not suffice, in the last
FILLINGS = (1, 1, 1, 1, 2, 2, 3, 3)
SMALL = 2  # steps after the first take rows of at most half of what is open


def in_order(names: DataFrame, column: str, number: str) -> DataFrame:
    """Number distinct texts from 0 by code point, null last.

    Ranges are the texts' first two characters; one task sees the texts of one
    range, and one row per range meets in the last window.
    """
    marked = names.withColumn("_range", F.substring(column, 1, 2))
    by_range = marked.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy(F.col("_range").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_range").orderBy(column)
    placed = marked.withColumn("_p", F.row_number().over(inside) - 1)
    joined = placed.join(offsets, F.col("_range").eqNullSafe(F.col("_r")))
    return joined.select(*names.columns, (F.col("_o") + F.col("_p")).cast("long").alias(number))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add `target` to rows of (weight, source_size): shares of the total by weight, at most
    max_epochs times the source's size. The excess of sources at their cap is shared again by
    weight among the others until none is above. Only two sums a round reach the driver."""
    exact = "decimal(38,0)"
    cap = (F.col("source_size") * max_epochs).cast(exact)
    weight = F.col("weight").cast(exact)
    row = sources.agg(F.sum(F.col("source_size").cast(exact)), F.sum(weight)).first()
    total, free = int(row[0] or 0), int(row[1] or 0)
    rest, above = total, F.lit(False)
    while free:
        above = cap * F.lit(free).cast(exact) < weight * F.lit(rest).cast(exact)
        row = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, weight))).first()
        now = (total - int(row[0] or 0), int(row[1] or 0))
        if now == (rest, free):
            break
        rest, free = now
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(free or 1))
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(share))


def mix(docs: DataFrame, size: Column | None = None, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Add size, source_size, target (of its source), times and taken (= size * times) to docs.

    Sources by code point, null last, get the weights in turn. Every document of
    a source is taken floor(target / source_size) times; the fraction is a seeded
    sample: documents in the order of a hash of seed, doc_id and text, as far as
    they fit, then, several times, documents of at most half of what stays open,
    the last times also documents that were taken already. The decision is a
    comparison of the row's hash and size with cuts of its source, so texts are
    never shuffled. No document is taken more than max_epochs times.

    Null doc_id, text or source are values like others (null text: size 0).
    Rows with the same doc_id and text are taken alike. A source without words
    has target 0 and times 0. No rows give no rows. Further columns stay, whatever their name; a
    column of docs with one of the added names is replaced.
    """
    added = ["size", "source_size", "target", "times", "taken"]
    size = word_count(F.col("text")) if size is None else size
    names = {c: c if c in ("doc_id", "text", "source") else f"caller_{i}" for i, c in enumerate(docs.columns) if c not in added}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], size.cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_spread"))

    light = staged(rows.select(F.col("source").alias("_s"), "size", "_spread"))
    sources = staged(in_order(light.groupBy("_s").agg(F.sum("size").alias("source_size")), "_s", "_sid"))
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_sid") % len(weights) + 1).cast("int"))
    filled = water_fill(staged(sources.withColumn("weight", turn.cast("long"))), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    filled = filled.withColumn("whole", epochs.cast("long"))
    filled = filled.withColumn("_want", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    filled = staged(filled)

    keys = filled.select(F.col("_s").alias("_k"), "_sid", "_want", F.col("whole").alias("_whole"))
    open_rows = light.join(keys, F.col("_s").eqNullSafe(F.col("_k"))).select("_sid", "_want", "_whole", "size", "_spread", F.lit(0).alias("_t"))
    open_rows = staged(open_rows)

    # each filling leaves a cut of the hash and a bound of the size per source
    cuts = None
    for i, limit in enumerate(FILLINGS):
        fits = open_rows.where((F.col("_t") < limit) & (F.col("_whole") + F.col("_t") < max_epochs))
        fits = staged(fits.where(F.col("size") <= F.col("_want") / SMALL) if i else fits)
        upto = prefix_sums(fits, ["_sid"], hash_part("_spread"), ["_spread"], {"_upto": "size"}, peers=True)
        upto = upto.where(F.col("_upto") <= F.col("_want")).groupBy("_sid")
        bound = F.first("_want") / SMALL if i else F.max(F.lit(2.0**62))
        step = F.struct(F.lit(i).alias("i"), F.lit(limit).alias("limit"), F.max("_spread").alias("cut"), bound.alias("bound"))
        cut = staged(upto.agg(F.max("_upto").alias("_got"), step.alias("_step")))
        cuts = cut.drop("_got") if cuts is None else cuts.unionByName(cut.drop("_got"))
        left = F.col("_want") - F.coalesce("_got", F.lit(0))
        again = F.when(F.col("_step").isNotNull() & _inside(F.col("_step"), F.col("_t"), max_epochs), 1).otherwise(0)
        open_rows = open_rows.join(cut, "_sid", "left")
        open_rows = staged(open_rows.select("_sid", left.alias("_want"), "_whole", "size", "_spread", (F.col("_t") + again).alias("_t")))
    steps = cuts.groupBy("_sid").agg(F.array_sort(F.collect_list("_step")).alias("_steps"))
    plan = filled.select(F.col("_s").alias("_k"), "source_size", "target", F.col("whole").alias("_whole"), "_sid")
    plan = staged(plan.join(steps, "_sid", "left").drop("_sid"))

    out = rows.join(plan, F.col("source").eqNullSafe(F.col("_k")))
    more = F.aggregate("_steps", F.lit(0), lambda t, x: t + F.when(_inside(x, t, max_epochs), 1).otherwise(0))
    times = F.when(F.col("source_size") > 0, F.col("_whole") + F.coalesce(more, F.lit(0))).otherwise(0).cast("long")
    out = out.withColumn("times", times)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


def _inside(step: Column, taken: Column, max_epochs: int) -> Column:
    """Whether a filling takes the row once more, after it was taken so many times beyond the whole repetitions."""
    fits = (F.col("_spread") <= step["cut"]) & (F.col("size") <= step["bound"])
    return fits & (taken < step["limit"]) & (F.col("_whole") + taken < max_epochs)


def repeat(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every row as many times as it is taken."""
    copies = F.sequence(F.lit(1), F.col("times").cast("int"))
    taken = mixed.where(F.col("times") > 0)
    return taken.withColumn("_copy", F.explode(copies)).select(*columns)


def op1_mix_sources(spark, folder):
    out = mix(documents(spark, folder))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "times")
