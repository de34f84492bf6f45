"""Toxicity: logistic regression on words and word beginnings, held still under swapped identity terms."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import documents, python_workers, whole
from tradewind.session import staged

# fixed values: terms that name a group of people, in English, German, French and Spanish;
# the terms of a line can stand for each other
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man"),
    ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("blind", "deaf", "disabled", "autistic"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus"),
    ("muslimisch", "christlich", "jüdisch"),
    ("schwarze", "weiße", "asiaten", "araber"),
    ("schwule", "lesben", "heterosexuelle"),
    ("flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs"),
    ("musulmane", "chrétienne", "juive"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("homosexuels", "hétérosexuels"),
    ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos"),
    ("negros", "blancos", "asiáticos", "árabes"),
    ("homosexuales", "heterosexuales"),
    ("inmigrantes", "refugiados", "extranjeros"),
)
# a character of a script without blanks, or at most 32 letters and digits
TOKEN = re.compile(r"[฀-๿぀-ヿ㐀-鿿]|\w{1,32}")
BEGINNINGS = range(3, 9)
SHIFTS = 2  # swapped versions of a text
EVIDENCE = 13.0  # log-likelihood ratio from which a feature is used
FEATURES = 4096
LABELLED = 200_000
BLOCK = 2000  # texts of a packed training block
GRID = 2**32  # residuals are rounded to it, so that sums do not depend on their order
CACHED = 500_000  # words a worker remembers


def words(text: str) -> set[str]:
    """Distinct tokens of a whole text, in lower case."""
    return set(TOKEN.findall(text.lower()))


def features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [f"{word}$", *[word[:n] for n in BEGINNINGS if n <= len(word)]]


def swapped(tokens: Iterable[str], identities: Sequence[Sequence[str]] = IDENTITIES, shifts: int = SHIFTS) -> list[set[str]]:
    """Versions of a text's words in which every identity term is the one 1, 2, ... places further on its line.
    A text without such terms has none."""
    own = set(tokens)
    out = []
    for shift in range(1, shifts + 1):
        moved = {}
        for line in identities:
            for i, term in enumerate(line):
                if term in own:
                    moved.setdefault(term, line[(i + shift) % len(line)])
        other = (own - moved.keys()) | set(moved.values())
        if other != own and other not in out:
            out.append(other)
    return out


def held_out(doc_id: Column) -> Column:
    """A fifth of all ids, never trained on; a null id counts as an empty one, which is held out."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 5 == 0


class Numbering:
    """Numbers of the model's features that occur in a set of words; words are looked up once."""

    def __init__(self, names: Sequence[str]) -> None:
        self.at = {f: i for i, f in enumerate(names)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, tokens: Iterable[str]) -> list[int]:
        found: set[int] = set()
        known, at = self.known, self.at
        if len(known) > CACHED:
            known.clear()
        for w in tokens:
            hits = known.get(w)
            if hits is None:
                hits = known[w] = tuple(at[f] for f in features(w) if f in at)
            if hits:
                found.update(hits)
        return sorted(found)


@dataclass(frozen=True)
class Toxicity:
    """Weights of features, and a bias."""

    names: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float

    def add(self, df: DataFrame, text: str = "text", out: str = "toxicity") -> DataFrame:
        """Add the score (0 to 1) of every whole text; null counts as empty, and an empty text
        has the score of the bias. Other columns stay; a column called `out` is an error."""
        if out in df.columns:
            raise ValueError(f"column {out} exists")
        python_workers(df.sparkSession)
        names, weights, bias = self.names, self.weights, self.bias

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            numbered = Numbering(names)
            for texts in batches:
                z = [bias + math.fsum(weights[i] for i in numbered(words(t))) for t in texts]
                yield pd.Series([sigmoid(x) for x in z], dtype="float64")

        return df.withColumn(out, run(whole(F.col(text))))


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def labelled_ids(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, toxic of the ids to learn from: labelled, not held out, and by their hash about `most` of them.
    An id that any row marks 1 is toxic; null ids and labels play no part."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    ids = known.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n = ids.count()
    if n > most:
        ids = ids.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(2**31)) < int(2**31 * most / n))
    return ids


def counted_words(texts: DataFrame) -> DataFrame:
    """word, clean, toxic: texts of either label that hold a word; the empty word counts all texts.
    Every task adds up what it reads before anything is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pd.DataFrame:
            rows = [(w, counts[0][w], counts[1][w]) for w in counts[0].keys() | counts[1].keys()]
            counts[0].clear(), counts[1].clear()
            return pd.DataFrame(rows, columns=["word", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                counts[toxic].update(words(text))
                counts[toxic][""] += 1
            if len(counts[0]) + len(counts[1]) > CACHED:
                yield flush()
        yield flush()

    counted = texts.mapInPandas(run, "word string, clean long, toxic long")
    return counted.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def chosen_features(counts: DataFrame, clean: int, toxic: int, evidence: float = EVIDENCE, most: int = FEATURES) -> list[str]:
    """Features that speak for a toxic text: those of the largest log-likelihood ratio, at most `most`."""
    beginnings = [F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in BEGINNINGS]
    made = F.filter(F.array(F.concat("word", F.lit("$")), *beginnings), lambda f: f.isNotNull())
    each = counts.where("word <> ''").select(F.explode(made).alias("feature"), "clean", "toxic")
    each = each.groupBy("feature").agg(F.sum("clean").cast("double").alias("c"), F.sum("toxic").cast("double").alias("t"))
    rate = toxic / (clean + toxic)
    n = F.col("c") + F.col("t")
    part = lambda x, share: F.when(x > 0, x * F.log(x / (n * share))).otherwise(0.0)
    ratio = 2 * (part(F.col("c"), 1 - rate) + part(F.col("t"), rate))
    strong = each.withColumn("ratio", F.round(ratio, 6)).where((F.col("ratio") >= evidence) & (F.col("t") > n * rate) & (n >= 3))
    return [r["feature"] for r in strong.orderBy(F.col("ratio").desc(), "feature").limit(most).collect()]


def training_blocks(texts: DataFrame, names: Sequence[str], identities: Sequence[Sequence[str]]) -> DataFrame:
    """Packed texts of the sample: labels, feature numbers (all in one list, with lengths), and the same of the
    swapped versions with the place of the text each belongs to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbered = Numbering(names)
        y, x, owner, other = [], [], [], []

        def flush() -> pd.DataFrame:
            flat = lambda lists: np.array([i for one in lists for i in one], "<i4").tobytes()
            sizes = lambda lists: np.array([len(one) for one in lists], "<i4").tobytes()
            row = (np.array(y, "<i4").tobytes(), sizes(x), flat(x), np.array(owner, "<i4").tobytes(), sizes(other), flat(other))
            for held in (y, x, owner, other):
                held.clear()
            return pd.DataFrame([row], columns=["y", "x_n", "x", "owner", "o_n", "o"])

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                own = words(text)
                for version in swapped(own, identities):
                    owner.append(len(y))
                    other.append(numbered(version))
                y.append(int(toxic))
                x.append(numbered(own))
                if len(y) >= BLOCK:
                    yield flush()
        if y:
            yield flush()

    return staged(texts.mapInPandas(run, "y binary, x_n binary, x binary, owner binary, o_n binary, o binary"))


def block_gradient(row: Mapping[str, bytes], w: np.ndarray, penalty: float) -> np.ndarray:
    """Gradient of a block by feature, bias and loss last, in whole steps of 1 / GRID."""
    y, x_n, x, owner, o_n, o = (np.frombuffer(row[c], "<i4") for c in ("y", "x_n", "x", "owner", "o_n", "o"))

    def scores(n: np.ndarray, flat: np.ndarray) -> np.ndarray:
        # summed in steps too: any order of features and rows gives the same score
        steps = np.rint(w[:-1] * GRID).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(steps[flat])])
        at = np.concatenate([[0], np.cumsum(n)])
        return (ends[at[1:]] - ends[at[:-1]]) / GRID + w[-1]

    g = np.zeros(len(w) + 1, np.int64)
    z = scores(x_n, x)
    r = np.rint((1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * GRID).astype(np.int64)
    loss = np.logaddexp(0, z) - y * z
    np.add.at(g, x, np.repeat(r, x_n))
    g[-2] = r.sum()
    g[-1] = np.rint(loss * GRID).astype(np.int64).sum()
    if penalty and len(owner):
        d = z[owner] - scores(o_n, o)
        pull = np.rint(2 * penalty * d * GRID).astype(np.int64)
        np.add.at(g, o, -np.repeat(pull, o_n))
        back = np.zeros(len(y), np.int64)
        np.add.at(back, owner, pull)
        np.add.at(g, x, np.repeat(back, x_n))
        g[-1] += np.rint(penalty * d * d * GRID).astype(np.int64).sum()
    return g


def spark_objective(blocks: DataFrame, n: int, penalty: float, ridge: float) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """Loss and gradient over all blocks: one job, of which at most n + 2 sums reach the driver."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            g = np.zeros(n + 2, np.int64)
            for rows in batches:
                for row in rows.to_dict("records"):
                    g += block_gradient(row, w, penalty)
            used = np.flatnonzero(g)
            yield pd.DataFrame({"j": used.astype(np.int32), "g": g[used]})

        sums = np.zeros(n + 2)
        for r in blocks.mapInPandas(run, "j int, g long").groupBy("j").agg(F.sum("g").alias("g")).collect():
            sums[r["j"]] = r["g"] / GRID
        grad = sums[:-1].copy()
        grad[:-1] += ridge * w[:-1]
        return float(sums[-1] + ridge / 2 * (w[:-1] @ w[:-1])), grad

    return at


def descend(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 40, kept: int = 8, tolerance: float = 1e-5) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halved step lengths."""
    w = start
    value, grad = objective(w)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, shares = grad.copy(), []
        for s, y in reversed(moves):
            shares.append(s @ q / (s @ y))
            q -= shares[-1] * y
        if moves:
            s, y = moves[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(np.abs(grad).sum(), 1e-12)
        for (s, y), a in zip(moves, reversed(shares)):
            q += (a - y @ q / (s @ y)) * s
        length = 1.0
        while True:
            new, new_grad = objective(w - length * q)
            if new <= value - 1e-4 * length * (grad @ q) or length < 1e-4:
                break
            length /= 2
        if new >= value:
            return w
        s, y = -length * q, new_grad - grad
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-kept:]
        done = value - new < tolerance * abs(value)
        w, value, grad = w + s, new, new_grad
        if done:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    penalty: float = 1.0,
    ridge: float = 0.3,
    labelled: int = LABELLED,
    identities: Sequence[Sequence[str]] = IDENTITIES,
) -> Toxicity:
    """Learn from labelled documents that are not held out; text is the only input.

    Features are the words and word beginnings that speak for a toxic text. The loss is
    the logistic one, plus `penalty` times the squared change of a text's log-odds when its
    identity terms are swapped, plus `ridge` / 2 times the squared weights. At most
    about `labelled` ids, chosen by a hash, are learned from (they, and no
    texts, are broadcast); every step of the descent is a job over packed feature numbers.

    Repeated documents count as often as they occur; null texts are empty. Without labels
    of both kinds, or without features, the score of all texts is the smoothed share of toxic ones
    (a quarter without any labels). Other columns play no part.
    """
    python_workers(docs.sparkSession)
    ids = labelled_ids(labels, labelled)
    # at most about `labelled` rows of an id and a label
    texts = docs.select("doc_id", whole(F.col("text")).alias("text")).join(F.broadcast(ids), "doc_id").select("text", "toxic")
    counts = staged(counted_words(texts))
    total = counts.where("word = ''").first()
    clean, toxic = (int(total["clean"]), int(total["toxic"])) if total else (0, 0)
    prior = (toxic + 0.5) / (clean + toxic + 2)
    names = chosen_features(counts, clean, toxic) if clean and toxic else []
    bias = math.log(prior / (1 - prior))
    if not names:
        return Toxicity((), (), bias)
    blocks = training_blocks(texts, names, identities)
    w = descend(spark_objective(blocks, len(names), penalty, ridge), np.concatenate([np.zeros(len(names)), [bias]]))
    return Toxicity(tuple(names), tuple(w[:-1].tolist()), float(w[-1]))


def op12_toxicity(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = model.add(docs, out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
