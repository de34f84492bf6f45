"""Document fingerprints by I-Match: hashed subsets of a lexicon of mid-frequency terms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import apart, ascii_lower, documents, whole, words
from tradewind.session import staged

BAND = (3.0, 4.6)  # natural logarithm of documents / documents with the term
LITERAL = 8_000  # lexicon terms that go into the plan; a larger lexicon is joined
RATES = (1, 2, 3, 4, 5, 6, 7, 8)  # a random subset of the lexicon keeps a term in 2**rate
SUBSETS = 3  # subsets of each rate
DENSE = 2  # a subset that holds more of a text's terms than this says nothing about near texts


def terms(text: Column) -> Column:
    """Sorted 64-bit hashes of the distinct words."""
    return F.array_sort(F.array_distinct(F.transform(words(ascii_lower(whole(text))), lambda w: F.xxhash64(w))))


def lexicon(texts: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Terms (column t) whose inverse document frequency over all rows lies in the band."""
    found = texts.select(F.explode(terms(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    n = texts.count()
    low, high = n / math.exp(band[1]), n / math.exp(band[0])
    return found.where(F.col("df").between(low, max(high, 1))).select("t")


def components(kept: Column) -> list[Column]:
    """Hash of all terms, and of each subset's terms in sorted order; null where the subset
    has none of them, or more than DENSE (but for the sparsest subsets)."""
    second = F.transform(kept, lambda t: F.xxhash64(t))
    out, hashes, at = [F.when(F.size(kept) > 0, F.xxhash64(kept))], [kept, second], 0
    for rate in RATES:
        for _ in range(SUBSETS):
            # the subsets of a term are read off disjoint bits of its two hashes
            if at + rate > 64:
                hashes, at = hashes[1:], 0
            word, at = hashes[0], at + rate
            chosen = F.filter(word, _in_subset(at - rate, 2**rate - 1))
            held = F.size(chosen) > 0 if rate == max(RATES) else F.size(chosen).between(1, DENSE)
            out.append(F.when(held, F.xxhash64(chosen)))
    return out


def _in_subset(at: int, mask: int):
    return lambda t: F.shiftrightunsigned(t, at).bitwiseAND(F.lit(mask)) == 0


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components among those that either side has."""
    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    either = F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull())
    same = F.filter(either, lambda p: p["x"].eqNullSafe(p["y"]))
    return F.when(F.size(either) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(either))


def written(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda h: F.coalesce(F.lpad(F.hex(h), 16, "0"), F.lit("-"))), ".")


class IMatch:
    """Fingerprints against the lexicon of a corpus.

    A text's terms are its distinct words (ASCII letters in lower case). Those of
    the lexicon are kept; a text without any keeps all its terms. Each subset of
    the lexicon gives one component, the hash of the kept terms that it holds.
    Equal texts have equal fingerprints. Null counts as empty; a text without
    words has only empty components.
    """

    def __init__(self, corpus: DataFrame, band: tuple[float, float] = BAND, literal: int = LITERAL):
        chosen = staged(lexicon(corpus, band))
        self.inline = None
        if chosen.count() <= literal:
            self.inline = F.array(*[F.lit(r["t"]) for r in chosen.orderBy("t").collect()]).cast("array<long>")
        self.chosen = chosen

    def add(self, df: DataFrame, text: str, name: str) -> DataFrame:
        """Add the component array of a text column; a column that is already called so is replaced."""
        df, names = apart(df, [])
        words_of = names[text]
        if self.inline is not None:
            every = terms(F.col(words_of))
            kept = F.array_intersect(every, self.inline)
            df = df.withColumn("_every", every).withColumn("_kept", kept)
        else:
            # a lexicon of any size: one join on the term
            df = df.withColumn("_every", terms(F.col(words_of)))
            df = df.withColumn("_row", F.xxhash64("_every"))
            distinct = df.select("_row", F.explode("_every").alias("t")).distinct()
            kept = distinct.join(self.chosen, "t").groupBy("_row").agg(F.array_sort(F.collect_list("t")).alias("_kept"))
            df = df.join(kept, "_row", "left").drop("_row")
        kept = F.when(F.coalesce(F.size("_kept"), F.lit(0)) > 0, F.col("_kept")).otherwise(F.col("_every"))
        df = df.withColumn("_kept", kept)
        own = [F.col(c).alias(n) for n, c in names.items() if n != name]
        return df.select(*own, F.array(*components(F.col("_kept"))).alias(name))


def with_next(docs: DataFrame, carried: list[str], ranges: int) -> DataFrame:
    """Add next_<column> of the next row by ascending doc_id (null first, equal ids by text); the last row's next is the first.

    Rows are cut into ranges of doc_id by quantiles; the first row of a range is
    also sent to the range before it, so one shuffle is enough. A column that is already called
    next_<column> is replaced.
    """
    docs, names = apart(docs, ["doc_id", "text"])
    probe = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(p) for p in probe]), 20 * ranges)).first()[0] if probe else []
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<long>")
    here = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))), F.lit(0))
    df = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(here))
    # one row per range, at most as many as there are quantiles
    nulls = F.max(F.col("doc_id").isNull())
    heads = sorted((r["_range"], None if r["n"] else r["d"]) for r in df.groupBy("_range").agg(F.min("doc_id").alias("d"), nulls.alias("n")).collect())
    copies = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("halo")))
    for i, (_, head) in enumerate(heads):
        before = heads[i - 1][0]
        also = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("halo")), F.struct(F.lit(before).alias("r"), F.lit(True).alias("halo")))
        copies = F.when(F.col("doc_id").eqNullSafe(F.lit(head)), also).otherwise(copies)
    df = df.withColumn("_c", F.explode(copies)).withColumn("_range", F.col("_c.r")).withColumn("_halo", F.col("_c.halo"))
    in_order = Window.partitionBy("_range").orderBy("_halo", F.col("doc_id").asc_nulls_first(), "text")
    added = {f"next_{c}": F.lead(names[c]).over(in_order) for c in carried}
    own = {n: F.col(c) for n, c in names.items() if n not in added}
    df = df.select("_halo", *[v.alias(f"out_{i}") for i, v in enumerate([*own.values(), *added.values()])])
    return df.where("NOT _halo").drop("_halo").toDF(*own, *added)


def op2_imatch(spark, folder):
    docs = documents(spark, folder).select("doc_id", whole(F.col("text")).alias("text"))
    marks = IMatch(docs)
    ranges = min(256, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = with_next(marks.add(docs, "text", "_fp"), ["text", "_fp"], ranges)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    first = first.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "_fp", "next__fp")
    out = marks.add(first, "edited", "_efp")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("_fp")).alias("fingerprint"),
        written(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_fp"), F.col("_efp")).alias("near_edited"),
        likeness(F.col("_fp"), F.col("next__fp")).alias("near_next"),
    )
