"""The toxicity classifier: plain loss and gradient, plain selection, held-out accuracy, swapped identity terms."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import toxicity
from tradewind.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
FOLDER = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def made(n=600, seed=1):
    """Insults make a text toxic; one group is named in most of the toxic texts, but in clean ones too."""
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(plain) for _ in range(rng.randint(3, 30))]
        if toxic:
            text.append(rng.choice(["Idiot", "moron", "scum", "wretch", "dolt", "fool", "oaf", "cur"]))
            if rng.random() < 0.6:
                text[rng.randrange(len(text))] = "Muslim"
        elif rng.random() < 0.12:
            text[rng.randrange(len(text))] = rng.choice(["muslim", "christian", "jewish"])
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en", "a", None))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def frames(spark):
    rows, labels = made()
    return spark.createDataFrame(rows, DOCS).repartition(4).cache(), spark.createDataFrame(labels, LABELS).cache()


def test_words_and_swaps():
    assert toxicity.words("y" * 40) == {"y" * 32, "y" * 8}
    assert toxicity.features("abcd") == ["abcd$", "abc", "abcd"]
    lines = (("a", "b", "c"), ("x", "y"))
    assert toxicity.swapped({"a", "x", "z"}, lines) == [{"b", "y", "z"}, {"c", "x", "z"}]
    assert toxicity.swapped({"z"}, lines) == []
    assert toxicity.swapped({"x", "y"}, lines) == []


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    x = [sorted(rng.choice(6, size=rng.integers(0, 6), replace=False).tolist()) for _ in range(20)]
    y = rng.integers(0, 2, 20)
    owner = [0, 0, 3, 7]
    other = [sorted(rng.choice(6, size=3, replace=False).tolist()) for _ in owner]
    as_bytes = lambda v: np.array(v, "<i4").tobytes()
    flat = lambda lists: [i for one in lists for i in one]
    row = {"y": as_bytes(y), "x_n": as_bytes([len(i) for i in x]), "x": as_bytes(flat(x)), "owner": as_bytes(owner), "o_n": as_bytes([len(i) for i in other]), "o": as_bytes(flat(other))}

    def loss(w):
        z = [sum(w[i] for i in own) + w[-1] for own in x]
        out = sum(math.log1p(math.exp(s)) - t * s for s, t in zip(z, y))
        return out + 0.7 * sum((z[p] - sum(w[i] for i in o) - w[-1]) ** 2 for p, o in zip(owner, other))

    w = rng.normal(size=7)
    got = toxicity.block_gradient(row, w, 0.7) / toxicity.GRID
    assert got[-1] == pytest.approx(loss(w), abs=1e-6)
    for j in range(7):
        step = np.zeros(7)
        step[j] = 1e-5
        assert got[j] == pytest.approx((loss(w + step) - loss(w - step)) / 2e-5, abs=1e-4)


def test_features_like_plain(spark, frames):
    rows, labels = made()
    toxic = {d: t for d, _, t in labels if not held(d)}
    docs, marks = frames
    ids = toxicity.labelled_ids(marks)
    assert {r["doc_id"]: r["toxic"] for r in ids.collect()} == toxic
    counts = toxicity.counted_words(docs.join(ids, "doc_id").select("text", "toxic"))
    want = {}
    for d, text, *_ in rows:
        if d in toxic:
            for w in toxicity.words(text) | {""}:
                want.setdefault(w, [0, 0])[toxic[d]] += 1
    assert {r["word"]: [r["clean"], r["toxic"]] for r in counts.collect()} == want
    c, t = want.pop("")
    each = {}
    for w, (a, b) in want.items():
        for f in toxicity.features(w):
            e = each.setdefault(f, [0, 0])
            e[0], e[1] = e[0] + a, e[1] + b
    rate = t / (c + t)
    strong = []
    for f, (a, b) in each.items():
        n = a + b
        ratio = 2 * ((a * math.log(a / (n * (1 - rate))) if a else 0) + (b * math.log(b / (n * rate)) if b else 0))
        if n >= 3 and b > n * rate and ratio >= 13:
            strong.append((-round(ratio, 6), f))
    assert toxicity.chosen_features(counts, c, t) == [f for _, f in sorted(strong)]


def test_swaps_make_group_mentions_neutral(spark, frames):
    docs, marks = frames
    said = spark.createDataFrame([(0, "my muslim friend"), (1, "my christian friend"), (2, "this muslim is an idiot"), (3, "")], "doc_id long, text string")
    free, regular = (toxicity.train(docs, marks, penalty=p).add(said).orderBy("doc_id").collect() for p in (0.0, 3.0))
    gap = lambda rows: abs(rows[0]["toxicity"] - rows[1]["toxicity"])
    assert gap(regular) < 0.3 * gap(free)
    assert regular[0]["toxicity"] < 0.5 < regular[2]["toxicity"]
    clean = [(d, t) for d, t, *_ in made(seed=2)[0] if d % 4 and "muslim" in t.split()]
    false = [
        toxicity.train(docs, marks, penalty=p).add(spark.createDataFrame(clean, "doc_id long, text string")).where("toxicity >= 0.5").count()
        for p in (0.0, 3.0)
    ]
    assert false[1] <= false[0]


def test_same_for_any_layout(spark, frames):
    docs, marks = frames
    first, second = (toxicity.train(docs.repartition(n), marks.repartition(n)) for n in (1, 5))
    assert first == second


def test_sample_of_labels(spark, frames):
    marks = frames[1]
    n = toxicity.labelled_ids(marks).count()
    some = toxicity.labelled_ids(marks, 100)
    assert 60 <= some.count() <= 140 < n
    assert some.exceptAll(toxicity.labelled_ids(marks)).count() == 0


def test_odd_rows(spark):
    rows, labels = made(500)
    odd = [*rows, *rows[:5], (None, "no id", None, None, None), (None, None, None, None, None), (1900, None, "x", "y", 1), (1901, "", "x", "y", 1), (1902, "idiot " * 50_000, "x", "y", 1)]
    df = spark.createDataFrame(odd, DOCS)
    for name in ("toxic", "word", "ratio", "y", "owner", "score"):
        df = df.withColumn(name, F.lit("mine"))
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (4, 1, 0), (1901, 1, 0)], LABELS)
    got = toxicity.train(df, marks).add(df)
    assert got.columns == [*df.columns, "toxicity"]
    found = got.collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter((r[0], r[1]) for r in odd)
    assert all(0 <= r["toxicity"] <= 1 and r["score"] == "mine" for r in found)
    assert next(r["toxicity"] for r in found if r["doc_id"] == 1902) >= 0.5
    with pytest.raises(ValueError, match="score exists"):
        toxicity.train(df, marks).add(df, out="score")


def test_no_labels(spark, frames):
    docs = frames[0]
    none = spark.createDataFrame([], LABELS)
    assert {r["toxicity"] for r in toxicity.train(docs, none).add(docs).collect()} == {0.25}
    one_kind = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)
    assert all(r["toxicity"] < 0.1 for r in toxicity.train(docs, one_kind).add(docs).collect())
    assert toxicity.train(docs.limit(0), none).add(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic IS NOT NULL").select("doc_id", "toxic")
    scored = QUERIES["op12_toxicity"](spark, FOLDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    wins = np.mean([(a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in toxic for b in clean])
    assert wins >= 0.97
