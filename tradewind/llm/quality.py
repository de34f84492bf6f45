"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import apart, documents, free_shuffles, python_workers, whole
from tradewind.session import staged

ORDER = 5
BITS = 12  # an n-gram is packed from 12-bit codes of its characters
FOLD = 2048  # code points from here on share 2047 codes
START = 1  # code of the place before a text (a control character otherwise)
CHUNK = 64_000_000  # weight (weight()) of the documents that share a chunk and so ask once for an n-gram; at most half as much again
HELD_GRAMS = 8_000_000  # n-grams of a chunk that are held before they are merged
PIECE = 1_000_000  # characters that are held as arrays at a time
UNIFORM = 1.0 / 4096  # probability of a character by no count at all
MARKS = 24  # bits of the hash by which documents that surely aren't trusted are left out before the shuffle
HELD = 5  # one trusted document in so many is held out of the training and sets the bounds
HIGH = 0.98  # quantile of the held-out trusted text, in spreads above its language's centre, that bounds all text
LEVEL = 100  # characters of which a document weighs half a long one in its language's centre
FEW = 2.0  # documents that stand for all languages in the centre and spread of one, and for SPREAD in all
SPREAD = 0.1  # nats a character of spread where no held-out text says more


def codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(c < FOLD, c + 1, FOLD + 1 + c % (4095 - FOLD))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed ORDER-gram that ends at each character of each text, and the texts' lengths."""
    each = [codes(t) for t in texts]
    lengths = np.array([len(c) for c in each], np.int64)
    pad = np.full(ORDER - 1, START, np.int64)
    row = np.concatenate([x for c in each for x in (pad, c)]) if each else pad
    grams = np.zeros(max(0, len(row) - ORDER + 1), np.int64)
    for i in range(ORDER):
        grams = (grams << BITS) | row[i : i + len(grams)]
    # windows that end in the padding of the next text are left out
    starts = np.cumsum(lengths + ORDER - 1) - (lengths + ORDER - 1)
    keep = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)]) if len(lengths) else np.zeros(0, np.int64)
    return grams[keep], lengths


def pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE characters."""
    first, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= PIECE:
            yield first, i + 1
            first, n = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def merged():
        grams, at = np.unique(np.concatenate(held), return_inverse=True)
        return grams, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)

    for pdf in batches:
        texts = pdf["text"].tolist()
        for a, b in pieces(texts):
            g, n = np.unique(windows(texts[a:b])[0], return_counts=True)
            held.append(g)
            counts.append(n)
            if len(held) > 8:
                g, n = merged()
                if len(g) > 2_000_000:
                    yield pd.DataFrame({"g": g, "c": n})
                    held, counts = [], []
                else:
                    held, counts = [g], [n]
    if held:
        g, n = merged()
        yield pd.DataFrame({"g": g, "c": n})


def train(trusted: DataFrame) -> DataFrame:
    """The model: (o, g, p, bow) with the interpolated probability p of each n-gram g of order o
    that was seen, and the weight bow that g gives to the order below as a context.

    Counts are kept and joined by n-gram, in as many shards as the session
    shuffles into. The highest order counts occurrences, the lower ones distinct
    characters in front. Discounts come from the numbers of n-grams with counts 1 to 4;
    only those reach the driver.
    """
    python_workers(trusted.sparkSession)
    texts = trusted.select(whole(F.col("text")).alias("text"))
    counts = staged(texts.mapInPandas(_count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")))
    levels = {ORDER: counts}
    for o in range(ORDER - 1, 0, -1):
        suffix = F.col("g").bitwiseAND(F.lit((1 << (BITS * o)) - 1))
        levels[o] = staged(levels[o + 1].groupBy(suffix.alias("g")).agg(F.count("*").alias("c")))

    model, below, bows = None, None, {}
    for o in range(1, ORDER + 1):
        level = levels[o]
        seen = {r["c"]: r["n"] for r in level.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
        discount = discounts([seen.get(i, 0) for i in range(1, 5)])
        d = F.when(F.col("c") == 1, discount[0]).when(F.col("c") == 2, discount[1]).otherwise(discount[2])
        context = F.shiftright("g", BITS)
        rows = level.withColumns({"h": context, "d": F.least(d, F.col("c").cast("double"))})
        totals = rows.groupBy("h").agg(F.sum("c").alias("t"), F.sum("d").alias("off"))
        totals = staged(totals.select("h", "t", (F.col("off") / F.col("t")).alias("bow")))
        rows = rows.join(totals, "h").withColumn("own", (F.col("c") - F.col("d")) / F.col("t"))
        if below is None:
            level = rows.select("g", (F.col("own") + F.col("bow") * UNIFORM).alias("p"))
        else:
            suffix = F.col("g").bitwiseAND(F.lit((1 << (BITS * (o - 1))) - 1))
            rows = rows.withColumn("s", suffix).join(below.select(F.col("g").alias("s"), F.col("p").alias("q")), "s")
            level = rows.select("g", (F.col("own") + F.col("bow") * F.col("q")).alias("p"))
        below = staged(level)
        levels[o], bows[o - 1] = below, totals.select(F.col("h").alias("g"), "bow")
    for o in range(0, ORDER + 1):
        if o == 0:
            part = bows[0].select(F.lit(0).alias("o"), F.lit(0).cast("long").alias("g"), F.lit(UNIFORM).alias("p"), "bow")
        elif o == ORDER:
            part = levels[o].select(F.lit(o).alias("o"), "g", "p", F.lit(None).cast("double").alias("bow"))
        else:
            part = levels[o].join(bows[o], "g", "full").select(F.lit(o).alias("o"), "g", "p", "bow")
        model = part if model is None else model.unionByName(part)
    return model


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, from the numbers of n-grams with counts 1 to 4."""
    if not all(n):
        return (0.5, 0.75, 0.9)
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3))
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in zip((1, 2, 3), found))


def weight(text: Column) -> Column:
    """Characters of a text, and five times those of scripts with many characters, which share few n-grams."""
    return 2 * F.octet_length(text).cast("long") - F.char_length(text)


def _chunks(batches: Iterator[pd.DataFrame], with_texts: bool) -> Iterator[pd.DataFrame]:
    """Chunks of documents as they come: their texts packed, or the n-grams that they need.

    A chunk is named by a hash of its rows, so a name never stands for other rows.
    Only a piece of it is held as text; the rest is packed or reduced to n-grams.
    """
    packer = zstandard.ZstdCompressor(level=7)
    name, piece, out, size, chars = hashlib.blake2b(digest_size=8), [], [], 0, 0

    def close():
        """Pack the piece, or add its n-grams."""
        ids, keys, texts = (list(x) for x in zip(*piece))
        name.update(np.array(keys, np.int64).tobytes())
        if with_texts:
            blob = packer.compress("\x00".join(texts).encode("utf-8", "surrogatepass"))
            out.append((ids, keys, np.cumsum([len(t) for t in texts]).astype(np.int64).tobytes(), blob))
        else:
            out.append(np.unique(windows(texts)[0]))
            if len(out) > 1 and sum(map(len, out[1:])) > max(HELD_GRAMS, len(out[0])):
                out[:] = [np.unique(np.concatenate(out))]

    def emit():
        chunk = int.from_bytes(name.digest(), "little", signed=True)
        if with_texts:
            return pd.DataFrame([(chunk, *x) for x in out], columns=["chunk", "ids", "keys", "ends", "blob"])
        grams = np.unique(np.concatenate(out))
        frames = []
        for o in range(ORDER, 0, -1):
            contexts = np.unique(grams >> BITS)
            shorter = np.unique(grams & ((1 << (BITS * (o - 1))) - 1))
            frames.append(pd.DataFrame({"chunk": chunk, "o": o, "g": grams}))
            grams = np.union1d(contexts, shorter) if o > 1 else np.zeros(1, np.int64)
        frames.append(pd.DataFrame({"chunk": chunk, "o": 0, "g": np.zeros(1, np.int64)}))
        return pd.concat(frames)

    for pdf in batches:
        for row in zip(pdf["doc_id"].tolist(), pdf["key"].tolist(), pdf["text"].tolist()):
            piece.append(row)
            chars += len(row[2])
            size += 2 * len(row[2].encode("utf-8", "surrogatepass")) - len(row[2])
            full = size >= CHUNK * 3 // 2
            if full or chars >= PIECE:
                close()
                piece, chars = [], 0
            if full:
                yield emit()
                name, out, size = hashlib.blake2b(digest_size=8), [], 0
    if piece:
        close()
    if out:
        yield emit()


def log_probabilities(grams: np.ndarray, tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Natural logarithm of each ORDER-gram's probability from (sorted n-grams, p, bow) by order."""

    def look(o, g):
        keys, p, bow = tables[o]
        if not len(keys):
            return np.full(len(g), np.nan), np.full(len(g), np.nan)
        at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        hit = keys[at] == g
        return np.where(hit, p[at], np.nan), np.where(hit, bow[at], np.nan)

    # from the lowest order up: the probability of the longest n-gram seen, times the weights of the longer contexts
    p = np.full(len(grams), UNIFORM)
    for o in range(1, ORDER + 1):
        g = grams & ((1 << (BITS * o)) - 1)
        own, _ = look(o, g)
        _, bow = look(o - 1, g >> BITS)
        p = np.where(np.isnan(own), p * np.where(np.isnan(bow), 1.0, bow), own)
    return np.log(p)


def _score(model: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
    tables = {}
    if len(packed) and not len(model):
        raise RuntimeError("a chunk of documents came without its n-grams: its rows changed between two reads")
    for o in range(ORDER + 1):
        part = model[model["o"] == o].sort_values("g")
        tables[o] = tuple(part[c].to_numpy(t) for c, t in (("g", np.int64), ("p", np.float64), ("bow", np.float64)))
    unpacker = zstandard.ZstdDecompressor()
    out = []
    for _, r in packed.iterrows():
        text = unpacker.decompress(r["blob"]).decode("utf-8", "surrogatepass")
        ends = np.frombuffer(r["ends"], np.int64)
        places = np.arange(len(ends))
        texts = [text[a + i : b + i] for i, a, b in zip(places, np.concatenate([[0], ends[:-1]]), ends)]
        grams, lengths = windows(texts)
        distinct, at = np.unique(grams, return_inverse=True)
        logs = np.concatenate([[0.0], np.cumsum(log_probabilities(distinct, tables)[at])])
        stops = np.cumsum(lengths)
        loss = -(logs[stops] - logs[stops - lengths]) / np.maximum(lengths, 1)
        out += zip(r["ids"], r["keys"], lengths.tolist(), loss.tolist())
    frame = pd.DataFrame(out, columns=["doc_id", "key", "n", "loss"])
    return frame.astype({"doc_id": "Int64", "key": "int64", "n": "int64", "loss": "float64"})


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, key, n (characters), loss (nats a character) of each row of (doc_id, key, text).

    Documents stay in chunks as they are read. A chunk asks for its distinct
    n-grams, which are joined with the sharded counts, and gets their weights
    back; so texts are moved once, packed, and each n-gram once a chunk. Small
    partitions are read together, up to CHUNK each, as long as every core has one.
    """
    spark = docs.sparkSession
    python_workers(spark)
    rows = docs.select("doc_id", "key", whole(F.col("text")).alias("text"))
    total = rows.agg(F.sum(weight(F.col("text")))).first()[0] or 0
    rows = rows.coalesce(max(spark.sparkContext.defaultParallelism, math.ceil(total / CHUNK)))
    asked = rows.mapInPandas(lambda it: _chunks(it, False), "chunk long, o int, g long")
    known = asked.join(model, ["o", "g"], "left").where("o = 0 OR p IS NOT NULL OR bow IS NOT NULL")
    known = known.select("chunk", "o", "g", F.col("p").cast("float").alias("p"), F.col("bow").cast("float").alias("bow"))
    packed = rows.mapInPandas(lambda it: _chunks(it, True), "chunk long, ids array<long>, keys array<long>, ends binary, blob binary")
    return (
        known.groupBy("chunk")
        .cogroup(packed.groupBy("chunk"))
        .applyInPandas(_score, "doc_id long, key long, n long, loss double")
    )


def chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs (doc_id, text) whose doc_id is one of ids, each there once, without a bound on their number.

    A bitmap of hashed ids, of 2 MB whatever their number, leaves out most other
    rows where they are read; texts of the rest are shuffled and joined exactly.
    A semi join would be moved below the bitmap, and all texts be shuffled.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MARKS)) + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    maps = ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_map"))
    rows = docs.withColumns({"_b": bucket, "_bit": bit}).join(F.broadcast(maps), F.col("_b") == F.col("_bucket"))
    byte = F.conv(F.hex(F.substring("_map", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    marked = byte.bitwiseAND(F.expr("shiftleft(1L, cast(_bit % 8 AS int))")) != 0
    return rows.where(marked).select(*docs.columns).join(ids, "doc_id").select(*docs.columns)


def bounds(rows: DataFrame, sure: DataFrame, high: float) -> DataFrame:
    """Add `bound`, the highest loss allowed, to rows (lang, n) by held-out trusted text sure (lang, n, loss).

    One rule for any number of rows: the bound is a language's centre plus t
    spreads, where the squared spread follows v0 + v1 / n in the length n, times a
    factor of the language, and t is the quantile `high` of the held-out text, at
    least 1. Centre and factor of a language with few documents lean towards those
    of all. Sums by language and a histogram of fixed width are all that is
    gathered; five sums and the quantile reach the driver. Without sure rows the
    bound is null.
    """
    if not sure.head(1):
        return rows.withColumn("bound", F.lit(None).cast("double"))
    weight = F.col("n") / (F.col("n") + LEVEL)
    mean = sure.agg(F.sum(weight * F.col("loss")) / F.sum(weight)).first()[0]
    centre = (F.sum(weight * F.col("loss")) + FEW * mean) / (F.sum(weight) + FEW)
    centres = staged(sure.groupBy(F.col("lang").alias("_lang")).agg(centre.alias("centre")))
    near = sure.join(centres, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang")
    near = staged(near.withColumn("off", F.col("loss") - F.col("centre")))

    # weighted least squares of the squared distance on 1 and 1 / n
    x, y = 1 / F.col("n"), F.col("off") ** 2
    w = 1 / (x + 1 / (3 * LEVEL)) ** 2
    a, b, c, d, e, count, square = near.agg(*map(F.sum, (w, w * x, w * x * x, w * y, w * x * y)), F.count("*"), F.avg(y)).first()
    det = a * c - b * b
    v0, v1 = (square, 0.0) if det <= 1e-9 * a * c else ((c * d - b * e) / det, (a * e - b * d) / det)
    if v1 < 0:
        v0, v1 = d / a, 0.0
    v0 = (max(v0, 0.0) * count + SPREAD**2 * FEW) / (count + FEW)
    trend = F.lit(v0) + F.lit(v1) / F.greatest(F.col("n"), F.lit(1))

    share = y / trend
    most = near.agg(F.avg(share)).first()[0]
    factors = near.groupBy(F.col("lang").alias("_lang")).agg(
        F.first("centre").alias("centre"), ((F.sum(share) + FEW * most) / (F.count("*") + FEW)).alias("factor")
    )
    factors = staged(factors)
    spread = F.sqrt(F.coalesce("factor", F.lit(most)) * trend)
    near = near.drop("centre").join(factors, F.col("lang").eqNullSafe(F.col("_lang")))
    step = F.greatest(F.lit(-100_000), F.least(F.lit(100_000), F.ceil(F.col("off") / spread * 1000)))
    steps = near.groupBy(step.alias("t")).agg(F.count("*").alias("c"))
    t = steps.agg(F.percentile("t", F.lit(high), F.col("c"))).first()[0]
    t = 1.0 if t is None else max(1.0, t / 1000)
    out = rows.join(factors, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    out = out.withColumn("bound", F.coalesce("centre", F.lit(mean)) + t * spread)
    return out.drop("_lang", "centre", "factor")


def classify(docs: DataFrame, labels: DataFrame, high: float = HIGH) -> DataFrame:
    """doc_id, key, lang, trusted, n_chars, loss, perplexity, upper, keep of every row of docs.

    The model is trained on four fifths of the texts labelled with quality 1; the
    others are held out, chosen by a hash of the text, so that the bounds
    hold for text that the model has not seen. Perplexity is per character. Its
    upper bound is set by `bounds` for the row's language and length. Text above
    the bound is rejected.

    Null text counts as empty; an empty text has perplexity 1 and is kept. Null
    lang is a language of its own. Rows with the same doc_id and text are
    scored alike and come once. Without held-out text everything is kept. No rows give no
    rows. Null or repeated labels, and null doc_ids in them, are no trouble: one
    label of quality 1 makes a document trusted.
    """
    free_shuffles(docs.sparkSession)
    text = whole(F.col("text"))
    key = F.xxhash64("doc_id", text)
    held = F.pmod(F.xxhash64(F.lit(5), text), F.lit(HELD)) == 0
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    good = good.withColumn("trusted", F.lit(True))
    marks = docs.select("doc_id", "lang", key.alias("key"), held.alias("held")).dropDuplicates(["key"])
    marks = staged(marks.join(good, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))))
    model = staged(train(chosen(docs.where(~held).select("doc_id", "text"), good.select("doc_id"))))
    scored = score(docs.select("doc_id", "text", key.alias("key")), model).drop("doc_id").dropDuplicates(["key"])
    scored = staged(scored.join(marks, "key"))
    out = bounds(scored, scored.where("trusted AND held AND n > 0").select("lang", "n", "loss"), high)
    out = out.withColumns({"upper": F.exp("bound"), "perplexity": F.exp("loss")})
    keep = (F.col("n") == 0) | F.coalesce(F.col("perplexity") <= F.col("upper"), F.lit(True))
    return out.select("doc_id", "key", "lang", "trusted", F.col("n").alias("n_chars"), "loss", "perplexity", "upper", keep.alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the classifier rejects; further columns stay, whatever their name."""
    found = classify(docs, labels)
    rejected = found.where(~F.col("keep")).select("key").distinct()
    rows, names = apart(docs, ("doc_id", "text"))
    kept = rows.withColumn("key", F.xxhash64("doc_id", whole(F.col("text")))).join(rejected, "key", "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def op5_quality(spark, folder):
    found = classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return found.drop("key")
