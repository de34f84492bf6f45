"""Line dedup: exact copies and copies within one word or, in short lines, one character, by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import apart, documents, free_shuffles, whole, words
from tradewind.session import staged

MIN_WORDS = 8  # shorter lines are compared by characters, those under 8 characters exactly
SEGMENTS = 8
CLASS = ["k1", "k2"]
ROW = ["_d", "_h"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Add what a row is known by; rows with equal doc_id and text are one."""
    text = whole(F.col("text"))
    return docs.withColumns({"_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")), "_h": F.xxhash64(text)})


def _spaced(line: Column) -> Column:
    """The words of a line with one blank between them; only lines with other white space are split."""
    other = F.lit(False)
    for c in ("  ", "\t", "\x0b", "\f", "\r"):
        other = other | F.contains(line, F.lit(c))
    return F.when(other, F.array_join(words(line), " ")).otherwise(F.trim(line))


def _lines(keyed: DataFrame) -> DataFrame:
    exploded = keyed.select(*ROW, F.posexplode(F.split(whole(F.col("text")), "\n")).alias("no", "line"))
    return exploded.select(*ROW, "no", _spaced(F.col("line")).alias("s"))


def _tokens(w: Column) -> Column:
    """What one edit may change of a line of words w: its words, or the characters of a line under MIN_WORDS.

    Characters come behind a blank, so that they are equal to no word.
    """
    letters = F.transform(F.split(F.array_join(w, " "), ""), lambda c: F.concat(F.lit(" "), c))
    return F.when(F.size(w) >= MIN_WORDS, w).otherwise(letters)


def _first_words(w: Column, m: Column) -> Column:
    return F.slice(w, F.lit(1), m)


def _last_words(w: Column, m: Column) -> Column:
    return F.slice(w, F.size(w) - m + 1, m)


def _without(w: Column, i: Column) -> Column:
    """The array without element i, from 0."""
    return F.concat(F.slice(w, F.lit(1), i), F.slice(w, i + 2, F.size(w) - i - 1))


def _classes(lines: DataFrame, halved: bool = False) -> DataFrame:
    """Lines with equal words and their place; if `halved`, also the hashes of the halves of their tokens.

    Of two lines within one token, of m tokens the shorter, either the first or
    the last m/2 tokens agree. A line can be the shorter (m = n) or the longer
    one (m = n - 1). Halves are cut from the text, so that no line is taken apart.
    """
    s, n = F.col("s"), F.col("n")
    rows = lines.where(s != "").select(
        F.xxhash64("s").alias("k1"), F.xxhash64(F.lit(1), "s").alias("k2"), F.struct(*ROW, "no").alias("at"), *["s"] * halved
    )
    if not halved:
        return rows
    blanks = F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit("")))
    rows = rows.withColumn("words", blanks + 1)
    long = F.col("words") >= MIN_WORDS
    rows = rows.withColumn("n", F.when(long, F.col("words")).otherwise(F.char_length(s)))

    def halves(m):
        half = F.floor(m / 2).cast("int")
        first = F.when(long, F.call_function("substring_index", s, F.lit(" "), half)).otherwise(F.substring(s, F.lit(1), half))
        last = F.when(long, F.call_function("substring_index", s, F.lit(" "), -half)).otherwise(F.substring(s, n - half + 1, half))
        return [F.xxhash64(first, m, long), F.xxhash64(last, m, long, F.lit(1))]

    keys = F.when(n > MIN_WORDS, F.array(*halves(n), *halves(n - 1))).when(n == MIN_WORDS, F.array(*halves(n)))
    return rows.select(*CLASS, "at", keys.alias("halves"))


def near_lines(docs: DataFrame) -> DataFrame:
    """Classes (k1, k2) of lines that have an earlier line, by (doc_id, line), within one token: a
    word changed, added or taken away, both lines of at least MIN_WORDS words, or a character, both
    of fewer words and at least MIN_WORDS characters."""
    free_shuffles(docs.sparkSession)
    keyed = _keyed(docs)
    # told after the grouping, as a filter before it would hash every line once more
    classes = _classes(_lines(keyed), halved=True).groupBy(*CLASS).agg(F.min("at").alias("at"), F.first("halves").alias("halves"))
    classes = staged(classes.where("halves IS NOT NULL"))
    halves = classes.select(*CLASS, F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    alike = halves.join(shared, "half").select(*CLASS).distinct().join(classes.drop("halves"), CLASS)

    # the words of lines that share a half, from their earliest place
    wanted = staged(alike).select(*CLASS, "at.*").groupBy(*ROW).agg(F.collect_list(F.struct(*CLASS, "no")).alias("wanted"))
    lines = F.split(whole(F.col("text")), "\n")
    asked = keyed.select(*ROW, "text").join(wanted, ROW)
    # only the lines asked for leave the row, not the whole text with each of them
    picked = F.transform("wanted", lambda x: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["no"].alias("no"), F.get(F.col("_lines"), x["no"]).alias("line")))
    picked = asked.withColumn("_lines", lines).select(*ROW, F.explode(picked).alias("x"))
    found = picked.select("x.k1", "x.k2", F.struct(*ROW, F.col("x.no").alias("no")).alias("at"), F.col("x.line").alias("line"))
    found = staged(found.dropDuplicates(CLASS))

    # everything but one of 8 segments must agree as well; only positions in such a segment can differ
    hashed = found.select(*CLASS, F.transform(_tokens(words(F.col("line"))), lambda x: F.xxhash64(x)).alias("w")).withColumn("n", F.size("w"))

    def outside(m, part):
        def key(s):
            low, high = F.floor(s * m / SEGMENTS).cast("int"), F.floor((s + 1) * m / SEGMENTS).cast("int")
            seg = F.xxhash64(m, s, _first_words(F.col("w"), low), _last_words(F.col("w"), m - high))
            return F.struct(seg.alias("seg"), s.alias("s"), F.lit(part).alias("longer"))

        return [key(F.lit(s)) for s in range(SEGMENTS)]

    n = F.col("n")
    segments = F.when(n > MIN_WORDS, F.array(*outside(n, False), *outside(n - 1, True))).otherwise(F.array(*outside(n, False)))
    segments = hashed.select(*CLASS, F.explode(segments).alias("s")).select(*CLASS, "s.*")
    both = segments.groupBy("seg").agg(F.count("*").alias("c")).where("c > 1").select("seg")
    marks = segments.join(both, "seg").groupBy(*CLASS).agg(F.collect_set(F.struct("s", "longer")).alias("open"))
    found = staged(found.join(marks, CLASS))
    wide = found.select(*CLASS, "at", "open", F.transform(_tokens(words(F.col("line"))), lambda x: F.xxhash64(x)).alias("w")).withColumn("n", F.size("w"))

    # variants: a changed word leaves n - 1 words and its position, an added one leaves the other line.
    # Only the longer line deletes for the latter; the shorter stands for itself.
    def emitted(longer: bool, places, variant):
        """Variants of a line for its open segments, as (at, i, kind, v)."""
        chosen = F.filter("open", lambda o: o["longer"] == longer)
        at = F.array_distinct(F.flatten(F.transform(chosen, places)))
        return F.transform(at, variant)

    def bound(s, m):
        return F.floor(s * m / SEGMENTS).cast("int")

    def inside(o):
        return F.filter(F.sequence(bound(o["s"], n), bound(o["s"] + 1, n)), lambda i: i < bound(o["s"] + 1, n))

    def added(o):
        # a word may be added at either edge of a segment
        return F.sequence(bound(o["s"], n - 1), bound(o["s"] + 1, n - 1))

    def one(i, kind, v):
        return F.struct(i.alias("i"), F.lit(kind).alias("kind"), v.alias("v"))

    w = F.col("w")
    changed = emitted(False, inside, lambda i: one(i, 0, F.xxhash64(F.lit(0), n, i, _without(w, i))))
    longer = emitted(True, added, lambda i: one(i, 2, F.xxhash64(F.lit(1), _without(w, i))))
    itself = F.array(one(F.lit(-1), 1, F.xxhash64(F.lit(1), w)))
    variants = wide.select(*CLASS, "at", F.explode(F.concat(changed, longer, itself)).alias("e")).select(*CLASS, "at", "e.*")
    variants = staged(variants)

    # the earliest line of each kind under a key: enough to tell whether a line has an earlier one
    place = F.struct("at", *CLASS, "i")
    groups = variants.groupBy("v").agg(
        F.count("*").alias("c"), *[F.min(F.when(F.col("kind") == k, place)).alias(f"e{k}") for k in (0, 1, 2)]
    ).where("c > 1").drop("c")
    earliest = F.when(F.col("kind") == 0, F.col("e0")).when(F.col("kind") == 1, F.col("e2")).otherwise(F.col("e1"))
    pairs = variants.join(groups, "v").withColumn("e", earliest).where(F.col("e.at") < F.col("at"))
    pairs = pairs.select(*CLASS, "kind", "i", F.col("e.k1").alias("o1"), F.col("e.k2").alias("o2"), F.col("e.i").alias("oi"))

    # verified on the words
    own = found.select(*CLASS, _tokens(words(F.col("line"))).alias("a"))
    other = found.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), _tokens(words(F.col("line"))).alias("b"))
    checked = pairs.join(own, CLASS).join(other, ["o1", "o2"])
    differ = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y)), lambda same: ~same))
    right = (
        F.when(F.col("kind") == 0, (F.size("a") == F.size("b")) & (differ == 1))
        .when(F.col("kind") == 2, _without(F.col("a"), F.col("i")) == F.col("b"))
        .otherwise(_without(F.col("b"), F.col("oi")) == F.col("a"))
    )
    return checked.where(right).select(*CLASS).distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with text freed of repeated lines, and n_lines, n_dropped.

    A line is dropped if a line with the same words, or within one word (both of
    at least 8 words) or one character (both of fewer words and at least 8
    characters, blanks between words counted once), stands earlier by (doc_id, hash of the text, line). Lines
    without words stay. The other lines keep their order.

    Null doc_id comes first; null text counts as empty. Rows with equal doc_id
    and text count as one and lose the same lines. No rows give no rows. Further
    columns stay, whatever their name; columns named n_lines or n_dropped are replaced.
    """
    free_shuffles(docs.sparkSession)
    docs, names = apart(docs, ("doc_id", "text"))
    keyed = _keyed(docs)
    rows = staged(_classes(_lines(keyed)).distinct())
    classes = rows.groupBy(*CLASS).agg(F.min("at").alias("first"), F.count("*").alias("c"))
    near = near_lines(docs).withColumn("near", F.lit(True))
    classes = classes.join(near, CLASS, "left").where("c > 1 OR near")
    dropped = rows.join(classes, CLASS).where(F.col("near") | (F.col("at") != F.col("first")))
    dropped = dropped.select("at.*").groupBy(*ROW).agg(F.collect_list("no").alias("_dropped"))

    joined = keyed.join(staged(dropped), ROW, "left")
    lines = F.split(whole(F.col("text")), "\n")
    joined = joined.withColumn("_lines", lines).withColumn("_dropped", F.coalesce("_dropped", F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    text = F.when(F.size("_dropped") > 0, F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")).otherwise(F.col("text"))
    joined = joined.withColumns(
        {"text": text, "n_lines": F.size("_lines").cast("long"), "n_dropped": F.size("_dropped").cast("long")}
    )
    kept = [F.col(n).alias(c) for c, n in names.items() if c not in ("n_lines", "n_dropped")]
    return joined.select(*kept, "n_lines", "n_dropped")


def op6_line_dedup(spark, folder):
    return dedup_lines(documents(spark, folder).select("doc_id", "text"))
