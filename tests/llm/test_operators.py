"""Every operator beside a plain version, on rows with nulls, ties, repeated rows, empty and long texts."""

import math
import random
import time
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import tiktoken  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tradewind import session
from tradewind.llm import bpe, chat, fingerprints, jaccard, lengths, lines, mixing, quality, sharding, topk
from tradewind.llm.links import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = ["".join(random.Random(i).choices("abcdefgh", k=5)) for i in range(300)]


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def made(seed=1, n=60):
    """Documents of several lines, near copies, exact copies, shared lines, odd ones."""
    rng = random.Random(seed)
    shared = [sentence(rng, 12) for _ in range(5)]
    rows = []
    for i in range(n):
        if i > 10 and rng.random() < 0.4:
            old = rng.choice(rows)[1] or ""
            w = old.split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            if rng.random() < 0.3:
                w.insert(rng.randrange(len(w)), rng.choice(VOCAB))
            text = " ".join(w)
        else:
            text = "\n".join([rng.choice(shared) if rng.random() < 0.3 else sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 6))])
        rows.append((i * 3, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "B", "ü", None]), len(text)))
    odd = [None, "", " \t\n", "Ab aB", "one", sentence(rng, 3000), "é́  x", rows[0][1].upper()]
    rows += [(1000 + i, t, "en", "a", None) for i, t in enumerate(odd)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def odd_rows(spark, rows):
    """With null ids, repeated rows and columns whose names the operators use themselves."""
    more = [*rows, *rows[:3], (None, "no id at all", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(more, DOCS)
    for name in ("size", "times", "whole", "key", "held", "lines", "n", "ids", "component", "g", "shard"):
        df = df.withColumn(name, F.lit("mine"))
    return df


# 1 -----------------------------------------------------------------------------


def test_mix(spark, docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = brute.water_fill(sizes)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["times"] <= 3 and r["taken"] == r["size"] * r["times"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        # what stays open is less than the smallest documents left
        assert abs(taken[s] - want[s]) <= 0.15 * want[s] + 5
    again = {(r["doc_id"], r["times"]) for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["times"]) for r in got}
    mixed = mixing.repeat(mixing.mix(docs), docs.columns)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times"] for r in got)


def test_mix_fills_up_beside_a_long_document(spark):
    rng = random.Random(5)
    rows = []
    for s in range(12):
        sizes = [40_000] + [int(rng.lognormvariate(4, 1.5)) + 1 for _ in range(250)]
        rows += [(s * 1000 + i, f"{s:02d}", n, str(s * 1000 + i)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long, text string")
    got = mixing.mix(df, size=F.col("n")).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k"))
    assert all(abs(r["t"] - r["k"]) <= 5 for r in got.collect())


def test_water_fill_clamps(spark):
    rows = [("a", 1, 10), ("b", 5, 10), ("c", 1, 1000)]
    got = mixing.water_fill(spark.createDataFrame(rows, "s string, weight long, source_size long"), 3).collect()
    assert {r["s"]: r["target"] for r in got} == {"a": 30.0, "b": 30.0, "c": 960.0}


# 2 -----------------------------------------------------------------------------


def fingerprint_frame(docs, literal):
    marks = fingerprints.IMatch(docs, band=(0.5, 3.5), literal=literal)
    first = fingerprints.with_next(marks.add(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "_fp"), ["text", "_fp"], 4)
    return first.select("doc_id", "text", "next_text", fingerprints.written(F.col("_fp")).alias("fp"))


def test_fingerprints(spark, docs, rows):
    got = fingerprint_frame(docs, 8000).collect()
    assert sorted((r["doc_id"], r["fp"]) for r in fingerprint_frame(docs, 0).collect()) == sorted((r["doc_id"], r["fp"]) for r in got)
    ids = sorted(r[0] for r in rows)
    texts = {r[0]: r[1] or "" for r in rows}
    by_text = {}
    for r in got:
        assert r["next_text"] == texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        key = tuple(sorted(set(brute.words(texts[r["doc_id"]].translate(brute.LOWER)))))
        assert by_text.setdefault(key, r["fp"]) == r["fp"]
    assert len(set(by_text.values())) > 0.9 * len(by_text) - 3


def test_imatch_query_small(spark):
    from tradewind.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op2_imatch"](spark, folder).collect()
    ids = sorted(docs)
    near = [0.0, 0.0]
    for r in got:
        t = docs[r["doc_id"]]
        nxt = docs[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == brute.sha(edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_edited"] == 1) or r["fingerprint"] != r["edited_fingerprint"]
        near[0] += r["near_edited"]
        near[1] += r["near_next"]
    assert len(got) == len(docs) and near[0] > 5 * near[1]


# 3 -----------------------------------------------------------------------------


def test_shards(spark, docs, rows):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    loads, slots, groups = [0] * 4, {}, {}
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(raw, set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(len(t.encode()) for t in texts.values())
    assert max(loads) - min(loads) <= longest
    assert all(len(s) == 1 for s in groups.values())


def test_shards_split_a_group_of_most_rows(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = sharding.shard(many, 4)
    loads = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 4 and max(loads) - min(loads) < 0.02 * sum(loads)
    held = got.where("size = 5 and text_crc32 = %d" % zlib.crc32(b"same")).groupBy("shard").count().count()
    assert held <= 4


# 4 -----------------------------------------------------------------------------


def conversations():
    rng = random.Random(5)
    rows = []
    for c in range(30):
        turn = 0
        if c % 3 == 0:
            rows.append((c, turn, "system", sentence(rng, rng.choice([0, 5, 900]))))
            turn += 1
        for i in range(rng.choice([0, 1, 2, 9, 40])):
            role = "user" if i % 2 == 0 else "assistant"
            text = rng.choice([sentence(rng, rng.randint(1, 60)), "a\\b<|turn|>\\<|x\n[INST]</s>\\", None, sentence(rng, 700)])
            rows.append((c, turn, role, text))
            turn += 1
    rows += [(99, t, "assistant" if t % 2 else "user", sentence(rng, 5)) for t in range(700)]
    rows += [(100, None, None, None), (100, 1, "assistant", "<|end|>"), (100, 1, "assistant", "<|end|>"), (None, 3, "assistant", "x")]
    return rows


def test_chat_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    shown = chat.windows(df.withColumn("p", F.lit(1)), budget=256, history=64)
    got = {r["conv_id"]: r for r in chat.digests(shown).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda x: x)
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), brute.sha(loss))
    back = chat.read_back(shown).collect()
    assert len([r for r in back if r["conv_id"] == 99]) > 10
    assert any(r["repeated"] for r in back if r["conv_id"] == 99)
    for r in back:
        assert r["n_tokens"] <= 256 or len(r["turns"]) == 1 or r["formatted"].startswith("<|turn|>system")
        marks = r["formatted"].count("<|turn|>")
        assert marks == r["formatted"].count("<|end|>") == len(r["turns"]) + r["repeated"]
        assert "</s>" not in r["formatted"] and "[INST]" not in r["formatted"]


# 5 -----------------------------------------------------------------------------


def test_kneser_ney_matches_definition(spark):
    rng = random.Random(3)
    trusted = [sentence(rng, 30) for _ in range(20)] + ["é", ""]
    others = [sentence(rng, 10), "zzzz zz", trusted[0][:50], "", "日本 text 日本", "a"]
    df = spark.createDataFrame([(t,) for t in trusted], "text string").repartition(3)
    model = quality.train(df)
    asked = spark.createDataFrame([(i, i, t) for i, t in enumerate(others)], "doc_id long, key long, text string").repartition(2)
    got = {r["doc_id"]: (r["n"], r["loss"]) for r in quality.score(asked, model).collect()}
    loss = brute.kneser_ney(trusted, quality.ORDER, quality.discounts, quality.UNIFORM)
    for i, t in enumerate(others):
        assert got[i][0] == len(t) and got[i][1] == pytest.approx(loss(t), abs=1e-5)


def test_classifier_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    assert found.count() == 1000
    share = {r["quality"]: r["k"] for r in found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert share[1] > 0.95 and share[0] < 0.2


def test_classifier_recall_by_length(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id")
    size = F.when(F.col("n_chars") < 256, 0).when(F.col("n_chars") < 1024, 1).when(F.col("n_chars") < 4096, 2).otherwise(3)
    kept = found.groupBy("quality", size.alias("size")).agg(F.avg(F.col("keep").cast("int")).alias("k"))
    share = {(r["quality"], r["size"]): r["k"] for r in kept.collect()}
    assert all(share[1, i] > 0.97 for i in range(4))
    assert share[0, 0] < 0.35 and all(share[0, i] < 0.05 for i in (1, 2, 3))


def test_bounds_lean_on_other_languages(spark):
    rng = random.Random(4)
    sure = [(lang, n, 1.5 + rng.gauss(0, 0.05 + 1 / n)) for lang in ("en", "de") for n in rng.choices(range(4, 4000), k=200)]
    sure += [("xx", 3, 3.0), (None, 500, 1.6)]
    sure = spark.createDataFrame(sure, "lang string, n long, loss double")
    asked = spark.createDataFrame([("en", 10), ("en", 3000), ("xx", 3000), (None, 3000), ("new", 3000)], "lang string, n long")
    got = {(r["lang"], r["n"]): r["bound"] for r in quality.bounds(asked, sure, quality.HIGH).collect()}
    assert len(got) == 5 and got["en", 10] > got["en", 3000]
    # one short text does not loosen the bound of its language's long ones
    assert all(1.55 < b < 2.2 for (lang, n), b in got.items() if n == 3000)
    assert {r["bound"] for r in quality.bounds(asked, sure.limit(0), quality.HIGH).collect()} == {None}


def test_training_takes_every_trusted_text(spark, monkeypatch):
    class Seen(Exception):
        pass

    def train(trusted):
        raise Seen(*trusted.agg(F.count("*"), F.count_distinct("doc_id"), F.max(F.col("doc_id") % 3)).first())

    monkeypatch.setattr(quality, "train", train)
    docs = spark.range(1_000_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.col("id").cast("string").alias("text"))
    labels = docs.where("doc_id % 3 = 0").select("doc_id", F.lit(1).alias("quality"))
    held = docs.where("doc_id % 3 = 0").where(F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(quality.HELD)) == 0).count()
    with pytest.raises(Seen) as seen:
        quality.classify(docs, labels)
    assert seen.value.args == (333_334 - held, 333_334 - held, 0)


def test_trusted_texts_are_marked_before_they_are_shuffled(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = quality.chosen(docs, docs.where("doc_id % 3 = 0").select("doc_id").distinct())
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    # the outer join, by doc_id, reads what the inner one, with the bitmap, leaves
    assert len(joins) == 2 and "doc_id" in joins[0] and "_bucket" in joins[1]
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(0, 1000, 3))


def test_small_partitions_share_a_chunk(spark, docs):
    df = docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), "text").dropDuplicates(["key"])
    model = quality.train(docs.where("doc_id % 2 = 0"))
    many = quality.score(spark.createDataFrame(df.collect(), df.schema).repartition(60), model)
    cores = spark.sparkContext.defaultParallelism
    assert many._jdf.queryExecution().optimizedPlan().toString().count(f"Repartition {cores}, false") == 2
    one = {r["key"]: r for r in quality.score(df.coalesce(1), model).collect()}
    got = {r["key"]: r for r in many.collect()}
    assert got.keys() == one.keys()
    assert all(r["n"] == one[k]["n"] and math.isclose(r["loss"], one[k]["loss"], rel_tol=1e-9, abs_tol=1e-12) for k, r in got.items())


def test_chunks_of_pieces(monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 50)
    monkeypatch.setattr(quality, "CHUNK", 300)
    monkeypatch.setattr(quality, "HELD_GRAMS", 20)
    rng = random.Random(4)
    texts = ["", "今天天气很好", "x" * 700] + [sentence(rng, rng.randint(0, 12)) for _ in range(60)]
    pdf = pd.DataFrame({"doc_id": range(len(texts)), "key": [7 * i for i in range(len(texts))], "text": texts})
    packed = list(quality._chunks(iter([pdf[:20], pdf[20:]]), True))
    asked = list(quality._chunks(iter([pdf[:20], pdf[20:]]), False))
    assert len(packed) > 3 and [set(x["chunk"]) for x in packed] == [set(x["chunk"]) for x in asked]
    assert [i for x in packed for ids in x["ids"] for i in ids] == list(range(len(texts)))
    for x, y in zip(packed, asked):
        grams = quality.windows([texts[i] for ids in x["ids"] for i in ids])[0]
        assert sorted(y[y["o"] == quality.ORDER]["g"]) == sorted(set(grams.tolist()))
        assert not y.duplicated(["o", "g"]).any()


# 6 -----------------------------------------------------------------------------


def test_line_dedup(spark, docs, rows):
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    want = brute.dedup_lines({r[0]: r[1] for r in rows})
    assert {d: (r["text"] or "") for d, r in got.items()} == want
    assert sum(r["n_dropped"] for r in got.values()) > 10
    texts = {r[0]: r[1] for r in rows}
    assert got[1000]["text"] is None and texts[1000] is None


def test_near_lines_within_one_word(spark):
    rng = random.Random(9)
    rows, n = [], 0
    for _ in range(40):
        w = sentence(rng, rng.randint(7, 30)).split()
        rows.append((n, " ".join(w)))
        for _ in range(rng.randint(0, 4)):
            n += 1
            v = list(w)
            i = rng.randrange(len(v))
            kind = rng.randrange(5)
            if kind == 0:
                v[i] = "changed"
            elif kind == 1:
                v.insert(i, "added")
            elif kind == 2:
                del v[i]
            elif kind == 3:
                v.append("last")
            else:
                v[i], v[-1] = "two", "changes"
            rows.append((n, " ".join(v)))
        n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}
    assert got == brute.dedup_lines(dict(rows))


def test_short_lines_within_one_character(spark):
    rows = [
        "Call 555-0134 now", "Call 555-0135 now", "Call  555-01345 now", "Call 555-134 now", "Call 666-0134 now",
        "今天天气很好我们去公园散步", "今天天气很好我们去公园跑步", "今天天气很好我们去公园散散步", "今天天气不好我们在家看书吧",
        "a b c d e f g h", "abcdefgh", "abcdefghi", "In.", "On.", "seven77", "seven78", "eight888", "eight889",
        "one two three four five six seven", "one two three four five six", "𝒳𝒳𝒳𝒳𝒳𝒳𝒳𝒳𝒳", "𝒳𝒳𝒳𝒳𝒳𝒳𝒳𝒳𝒴",
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    dropped = {r["doc_id"] for r in lines.dedup_lines(df).where("n_dropped > 0").collect()}
    assert dropped == {1, 2, 3, 6, 7, 11, 17, 21}


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in Path(d).rglob("shuffle_*.data")}


def test_line_dedup_frees_the_shuffles_of_its_steps(spark):
    rows = [(i, f"line {i % 7} of a text with some more words\nand one line {i} alone") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = shuffle_files(spark)
    got = lines.dedup_lines(df)
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert got.where("n_dropped > 0").count() == 59


def test_lines_with_other_white_space(spark):
    long = "one two three four five six seven eight nine"
    rows = ["", " ", long, "  one\ttwo  three\x0bfour five six\fseven eight nine\r", "one two three four five\u00a0six seven eight nine",
            "one two\t\tthree four five six seven eight ten", "\t", "short line", " short\tline "]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(df).collect()}
    assert {d for d, n in got.items() if n} == {3, 5, 8}


# 7 -----------------------------------------------------------------------------


def test_length_histogram(spark, docs, rows):
    coder = lengths.encoding(lengths.VOCABULARY)
    n = sorted(len(coder.encode_ordinary(r[1] or "")) for r in rows)
    hist = lengths.histogram(docs)
    for r in hist.collect():
        x = r["n_tokens"]
        assert r["n_docs"] == n.count(x)
        assert r["docs_at_least"] == sum(v >= x for v in n)
        assert r["tokens_at_least"] == sum(v for v in n if v >= x)
        assert r["tokens_truncated"] == sum(min(v, x) for v in n)
        assert r["quantile"] == pytest.approx(sum(v <= x for v in n) / len(n))
    for r in lengths.at_limits(hist, [0, 7, 50, 10**6]).collect():
        assert (r["docs_cut"], r["tokens_kept"]) == (sum(v > r["context"] for v in n), sum(min(v, r["context"]) for v in n))
    assert lengths.length_at(hist, 0.5) == n[math.ceil(0.5 * len(n)) - 1]


# 8 -----------------------------------------------------------------------------


def brute_top(vectors, k=5):
    rows = [(i, [math.floor(256 * x) for x in e]) for i, e in vectors if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), o) for m, (o, w) in enumerate(rows) if m != n and len(w) == len(v))
            out += [(q, r + 1, o, -s) for r, (s, o) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(400)]
    vectors += [(i, [0.5] * 6) for i in range(400, 600)]  # ties
    vectors += [(700, None), (750, [1.0, None]), (None, [0.5] * 6), (800, [float("nan")] * 6), (850, [float("inf")] * 6)]
    vectors += [(900, []), (950, [1.0, 2.0]), (951, [1.0, -2.0]), (400, [0.5] * 6), (400, [0.25] * 6), (401, [9.0] * 6), (50, [1.5] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    got = topk.top_k(df.withColumn("score", F.lit(1)), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(vectors)


def test_top_k_of_huge_values(spark):
    df = spark.createDataFrame([(0, [3e30, 1.0]), (1, [3e30, 2.0]), (2, [-3e30, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    far = 2**63 - 1
    assert got == [(1, 1, far), (2, 3, far), (3, 2, -far)]


# 9 -----------------------------------------------------------------------------


def test_bpe_matches_library(spark, docs, rows):
    own = Tokenizer.from_file(bpe.VOCABULARY)
    extra = ["<|endoftext|>a<|startoftext|>", "it's WE'LL</w>", "ΑΣ Σ ς İ", "x" * 5000, "日本語 123 ½ ²  　 \x1c"]
    texts = {r[0]: r[1] or "" for r in rows} | {5000 + i: t for i, t in enumerate(extra)}
    df = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([(5000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    for r in bpe.decode(bpe.encode(df)).collect():
        ids = own.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids
        assert r["decoded"] == own.decode(ids, skip_special_tokens=False)


# 10 ----------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "percent", "task"), [(3, 90, None), (5, 80, None), (3, 80, 300)])
def test_jaccard(spark, monkeypatch, n, percent, task):
    rows = made(seed=percent, n=150)
    if task:  # families are cut into blocks
        monkeypatch.setattr(jaccard, "TASK", task)
    df = spark.createDataFrame(rows, DOCS).select("doc_id", "text").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_classes(df, n, percent).collect()}
    assert got == brute.jaccard_components({r[0]: r[1] for r in rows}, n, percent)


@pytest.mark.parametrize(("pack", "bucket"), [(40, 30), (10**6, 10**6)])
def test_candidate_links_like_all_pairs(spark, monkeypatch, pack, bucket):
    """One key held by most classes, keys of few, a repeated class, one without keys; packs and buckets of any size."""
    monkeypatch.setattr(jaccard, "PACK", pack)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    rng = random.Random(8)
    spread = [rng.randrange(-(2**63), 2**63) for _ in range(400)]
    sets = {1000 + i: (rng.randrange(12), set(rng.sample(spread, rng.randint(1, 4))) | ({spread[0]} if i % 3 else set())) for i in range(120)}
    rows = [(k, c, sorted(keys)) for k, (c, keys) in sets.items()]
    df = spark.createDataFrame([*rows, rows[5], (7, 3, [])], "k long, c short, keys array<long>").repartition(6)
    got = {r["node"]: r["component"] for r in components(jaccard.candidate_links(df, 2)).collect()}
    near = [(x, y) for x in sets for y in sets if x < y and abs(sets[x][0] - sets[y][0]) <= 2 and sets[x][1] & sets[y][1]]
    want = dict(jaccard.stars(near))
    assert {k: v for k, v in got.items() if k != v} == want
    assert jaccard.candidate_links(df.limit(0), 2).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 84, 85, 90, 97])
def test_linked_sets_share_a_key(percent):
    """Any two different sets with their share in common, the smallest ones too, have a key in common."""
    rng, seen = random.Random(percent), 0
    length = jaccard.run_length(percent)
    for _ in range(4000):
        a = {rng.randrange(2**62) for _ in range(rng.choice([rng.randint(1, 12), rng.randint(1, 60), rng.randint(1, 400)]))}
        b = set(a)
        for _ in range(rng.randint(1, 1 + len(a) * (100 - percent) // 100)):
            b ^= {rng.choice([rng.choice(sorted(a)), rng.randrange(2**62), min(a) + rng.randrange(99)])}
        if a != b and 100 * len(a & b) >= percent * len(a | b):
            sets = (np.array(sorted(x), np.uint64) for x in (a, b))
            x, y = (set(jaccard.run_keys(s[: jaccard.prefix_length(len(s), percent, length)], length).tolist()) for s in sets)
            assert x & y
            seen += 1
    assert seen > 100


def test_tree_links_like_all_pairs():
    rng = random.Random(4)
    sets = []
    for _ in range(60):
        base = set(rng.sample(range(200), rng.randint(1, 40))) if not sets or rng.random() < 0.4 else set(map(int, rng.choice(sets)))
        for _ in range(rng.randint(0, 3)):
            base ^= {rng.randrange(200)}
        sets.append(np.array(sorted(base or {1}), np.uint64))
    links = jaccard.tree_links(sets, [0] * len(sets), 80)
    plain = {(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert set(links) <= plain

    def roots(pairs):
        p = list(range(60))

        def find(x):
            while p[x] != x:
                x = p[x]
            return x

        for a, b in pairs:
            x, y = find(a), find(b)
            p[max(x, y)] = min(x, y)
        return [find(i) for i in range(60)]

    assert roots(links) == roots(plain)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 100)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102, 200)}


def test_components_that_do_not_settle(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        components(chain, rounds=2)


# all ---------------------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int"
FRAMES = {
    "mix": lambda d, l: mixing.mix(d),
    "fingerprint": lambda d, l: fingerprints.with_next(fingerprints.IMatch(d).add(d, "text", "fp"), ["fp"], 3),
    "shard": lambda d, l: sharding.shard(d),
    "quality": lambda d, l: quality.keep_good(d, l),
    "lines": lambda d, l: lines.dedup_lines(d),
    "lengths": lambda d, l: lengths.histogram(d),
    "bpe": lambda d, l: bpe.decode(bpe.encode(d)),
    "jaccard": lambda d, l: jaccard.near_classes(d),
}


@pytest.mark.parametrize("name", FRAMES)
def test_odd_rows(spark, rows, empty, name):
    labels = spark.createDataFrame([(r[0], 1, None) for r in rows[:40]] + [(None, 1, 0), (3, None, None), (3, 1, 1)], LABELS)
    df = odd_rows(spark, rows)
    got = FRAMES[name](df, labels)
    if name in ("quality", "lengths"):
        assert got.count() > 0
    else:
        assert got.count() == df.count()
    none = spark.createDataFrame([], LABELS)
    assert FRAMES[name](empty, none).count() == 0
    assert FRAMES[name](df.limit(0), none).count() == 0


SCRATCH = ["_spread", "_k", "_s", "_sid", "_want", "_t", "_steps", "_whole", "_d", "_h", "_lines", "_dropped", "_key", "key", "near", "at", "no", "caller_1",
           "_every", "_kept", "_row", "_range", "_c", "_halo", "out_0"]


@pytest.mark.parametrize("name", ["mix", "fingerprint", "quality", "lines"])
def test_columns_named_like_scratch_columns(spark, rows, name):
    df = spark.createDataFrame(rows, DOCS)
    more = df.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in SCRATCH])
    labels = spark.createDataFrame([(r[0], 1, None) for r in rows[:40]], LABELS)
    plain, got = FRAMES[name](df, labels), FRAMES[name](more, labels)
    assert set(got.columns) == set(plain.columns) | set(SCRATCH)
    told = got.collect()
    assert all(r[c] == f"{c}{r['doc_id']}" for r in told for c in SCRATCH)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_empty_conversations_and_vectors(spark):
    assert chat.digests(chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


def test_jaccard_stores_links_once(spark, monkeypatch):
    """Near copies meet in many buckets; their links are stored without repeats."""
    monkeypatch.setattr(jaccard, "BUCKET", 50)
    stored = []

    def staged(df):
        out = session.staged(df)
        if out.columns == ["a", "b"]:
            stored.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(jaccard, "staged", staged)
    words = [f"w{i}" for i in range(300)]
    rows = [(d, " ".join([*words[:d], f"own{d}", *words[d:]])) for d in range(40)]
    found = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert {r["component_id"] for r in found.collect()} == {0}
    assert all(n == different for n, different in stored)
