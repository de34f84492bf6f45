"""N-gram Jaccard join: families of candidates by neighbouring n-grams, a prefix tree in each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import ascii_lower, documents, free_shuffles, python_workers, whole
from tradewind.llm.links import components
from tradewind.session import staged

TASK = 5_000_000  # n-grams that a task of the tree join should hold
BITS = 24  # of the mark table by which texts without candidates are left out
CLASS = 1.05  # ratio of the set sizes that share a size class
PACK = 1_000_000  # keys that a map task packs at once
BUCKET = 500_000  # keys that meet in a bucket, about
SPARE = 24  # bits of a key beyond those that number all keys

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = np.uint64(0x100000001B3)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, BASE, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


POWERS = _powers(64)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each run of bytes that are not ASCII white space."""
    b = np.frombuffer(text, np.uint8)
    dark = np.concatenate([[False], (b != 32) & ((b < 9) | (b > 13)), [False]])
    turns = np.flatnonzero(dark[1:] != dark[:-1])
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    # a word's hash is the sum of its bytes times a number that depends on the place in the word
    begin = np.zeros(len(b), np.int64)
    begin[starts] = starts
    place = np.arange(len(b)) - np.maximum.accumulate(begin)
    long = _mixed((place >> 6).astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    value = (b.astype(np.uint64) + np.uint64(1)) * POWERS[place & 63] * long
    value[~dark[1:-1]] = 0
    sums = np.add.reduceat(value, starts)
    return _mixed(sums + (ends - starts).astype(np.uint64) * MIX[0])


def ngrams(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word runs; a shorter text is one run; without words none."""
    w = word_hashes(text)
    if not len(w):
        return w
    m = max(1, len(w) - n + 1)
    h = np.zeros(m, np.uint64)
    for i in range(min(n, len(w))):
        h = _mixed(h * BASE + w[i : i + m] + np.uint64(i + 1))
    return np.unique(h)


def run_length(percent: int) -> int:
    """How many neighbouring n-grams make a key: as many as small linked sets surely have in common unparted."""
    return 3 if percent >= 85 else 2 if percent >= 75 else 1


def prefix_length(size: int, percent: int, run: int = 2) -> int:
    """How many n-grams, from the smallest hash on, hold `run` neighbours that a linked set has as neighbours too.

    Linked sets of a and b n-grams with o in common differ in D = a + b - 2 o. With r
    neighbours to a run, the first (r - 1) D + r common n-grams make (r - 1) D + 1 runs,
    and each difference parts r - 1 at most. The set has a - o of its own before the last of
    them at most; (r - 1) D + r + a - o is largest for the smallest b (for shares above
    (r - 1) / r), and then r a (1 - share) + r. There are so many common ones, as sets
    that differ at all have 1 / (1 - share) or more n-grams together, at the shares of run_length.
    """
    return min(size, run * size * (100 - percent) // 100 + run + 1)


def run_keys(first: np.ndarray, run: int) -> np.ndarray:
    """A hash of every `run` neighbours."""
    keys = first
    for i in range(1, run):
        keys = _mixed(keys[:-1] * BASE + first[i:])
    return keys


def _prefixes(n: int, percent: int):
    length = run_length(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                s = ngrams(bytes(text), n)
                keys = run_keys(s[: prefix_length(len(s), percent, length)], length)
                one = np.bitwise_xor.reduce(_mixed(s + MIX[0])) if len(s) else np.uint64(0)
                two = np.add.reduce(_mixed(s ^ MIX[1])) if len(s) else np.uint64(0)
                out.append((doc, len(s), int(np.int64(one.view(np.int64))), int(np.int64(two.view(np.int64))), keys.view(np.int64).tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "n", "d1", "d2", "keys"]).astype({"doc_id": "Int64"})

    return run


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers byte by byte: all first bytes, then all second ones; high bytes that agree compress to nothing."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(b: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def _chained(g: np.ndarray, c: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys in the order (g, c): which are the first of their (g, c), and the links of the others to it."""
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    head = k[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(k) else k
    apart = head != k
    return first, k[apart], head[apart]


def _joined(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The same components as those links have, each link to the smallest of its component."""
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return np.array(stars(pairs.tolist()), np.int64).reshape(-1, 2)


def _packed(per_pack: int, buckets: int, bits: int):
    """Keys of many classes, sorted and packed by bucket. Of the classes of one size class under
    a key one is sent, the others are linked to it here: a key that very many texts hold leaves a task once."""
    mask = np.uint64((1 << 64) - (1 << (64 - bits)))

    def pack(k, c, keys) -> pd.DataFrame:
        k, c = np.array(k, np.int64), np.array(c, np.int16)
        order = np.lexsort((k, c))
        k, c, keys = k[order], c[order], [keys[i] for i in order]
        g = np.concatenate(keys).astype(np.int64).view(np.uint64) & mask
        doc = np.repeat(np.arange(len(k)), [len(x) for x in keys])
        by_key = np.argsort(g, kind="stable")  # classes stay in their order under a key
        g, doc = g[by_key], doc[by_key]
        first, a, b = _chained(g, c[doc], k[doc])
        g, doc = g[first], doc[first]
        links = _joined([a], [b])
        at = ((g >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(g) else np.zeros(0, np.int64)
        out = []
        for lo, hi in zip(edges, [*edges[1:], len(g)]):
            own, place = np.unique(doc[lo:hi], return_inverse=True)
            here = links if lo == 0 else links[:0]
            out.append((int(at[lo]), _planes(g[lo:hi]), _planes(place.astype(np.int32)), _planes(k[own]), _planes(c[own]), here.tobytes()))
        return pd.DataFrame(out, columns=["bucket", "g", "doc", "k", "c", "links"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[list, list, list] = ([], [], [])
        n = 0
        for pdf in batches:
            for k, c, keys in zip(pdf["k"], pdf["c"], pdf["keys"]):
                for column, value in zip(held, (k, c, np.asarray(keys, np.int64))):
                    column.append(value)
                n += len(keys)
                if n >= per_pack:
                    yield pack(*held)
                    held, n = ([], [], []), 0
        if n:
            yield pack(*held)

    return run


def _met(reach: int):
    """Links of the classes that share a key in a bucket: of one size class to the smallest, and size classes within reach."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g, c, k, a, b = [], [], [], [], []
        for row in rows.itertuples():
            place = _numbers(row.doc, np.int32)
            g.append(_numbers(row.g, np.uint64))
            k.append(_numbers(row.k, np.int64)[place])
            c.append(_numbers(row.c, np.int16)[place])
            sent = np.frombuffer(row.links, np.int64).reshape(-1, 2)
            a.append(sent[:, 0])
            b.append(sent[:, 1])
        g, c, k = np.concatenate(g), np.concatenate(c), np.concatenate(k)
        order = np.lexsort((k, c, g))
        g, c, k = g[order], c[order], k[order]
        first, x, y = _chained(g, c, k)
        a.append(x)
        b.append(y)
        g, c, k = g[first], c[first], k[first]
        for step in range(1, reach + 1):
            near = np.flatnonzero((g[step:] == g[:-step]) & (c[step:] - c[:-step] <= reach))
            a.append(k[near])
            b.append(k[near + step])
        return pd.DataFrame(_joined(a, b), columns=["a", "b"])

    return run


def candidate_links(sets: DataFrame, reach: int) -> DataFrame:
    """a, b: links that put classes (k, size class c, keys) with a common key, at size classes
    at most `reach` apart, into one component.

    Every key is shuffled once, as a member of a packed row, with as many of its bits as tell
    the keys of this input apart but for one in 2**SPARE; two keys that agree by
    chance add candidates and lose none. The number of buckets follows the number of keys,
    which alone reaches the driver. Repeated rows link nothing new; a class without keys links nothing.
    """
    total = sets.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets, bits = max(1, -(-total // BUCKET)), min(64, total.bit_length() + SPARE)
    shape = "bucket long, g binary, doc binary, k binary, c binary, links binary"
    packed = sets.select("k", "c", "keys").mapInPandas(_packed(PACK, buckets, bits), shape)
    return packed.groupBy("bucket").applyInPandas(_met(reach), "a long, b long")


class _Tree:
    """A prefix tree over ordered sets; edges without branches are one node. Children come before their parent."""

    def __init__(self, members: list[int], sets: list[np.ndarray]):
        self.edge: list[np.ndarray] = []
        self.depth: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[list[int]] = []
        self.leaves: list[list[int]] = []
        members = sorted(members, key=lambda i: sets[i].tobytes())  # equal beginnings stand together
        # open nodes from the root to the last set: [depth, children, leaves, smallest size, largest size, a set below]
        path: list[list] = [[0, [], [], 1 << 60, 0, None]]

        def close(to: int) -> None:
            """Finish the nodes deeper than `to`; afterwards the last open node is that deep or less."""
            while path[-1][0] > to:
                depth, children, leaves, low, high, below = path.pop()
                if path[-1][0] < to:
                    path.append([to, [], [], 1 << 60, 0, below])
                above = path[-1]
                above[1].append(self._add(below[above[0] : depth], depth, children, leaves, low, high))
                above[3], above[4] = min(above[3], low), max(above[4], high)

        last = None
        for i in members:
            s = sets[i]
            if last is not None:
                m = min(len(s), len(last))
                other = np.flatnonzero(s[:m] != last[:m])
                close(int(other[0]) if len(other) else m)
            if path[-1][0] < len(s):
                path.append([len(s), [], [], 1 << 60, 0, s])
            top = path[-1]
            top[2].append(i)
            top[3], top[4] = min(top[3], len(s)), max(top[4], len(s))
            last = s
        close(0)
        _, children, leaves, low, high, _ = path[0]
        self._add(np.zeros(0, np.int64), 0, children, leaves, low, high)
        self._flatten(members, sets)

    def _add(self, edge, depth, children, leaves, low, high) -> int:
        for column, value in zip(
            (self.edge, self.depth, self.children, self.leaves, self.low, self.high), (edge, depth, children, leaves, low, high)
        ):
            column.append(value)
        return len(self.edge) - 1

    def _flatten(self, members: list[int], sets: list[np.ndarray]) -> None:
        """Columns for walks over the whole tree at once: the part of each edge above a depth at
        which sets that differ too much have shown it, and the tour through the nodes."""
        limit = self.high[-1] // 8 + 8
        upper = [e[: max(0, limit - d + len(e))] for e, d in zip(self.edge, self.depth)]
        self.grams, start, n = _flat(upper, np.int64)
        self.start, self.end = start, start + n
        self.upper_depth = np.minimum(self.depth, limit)
        tour, todo = [], [(len(self.edge) - 1, 1)]
        while todo:
            v, sign = todo.pop()
            tour.append((v, sign))
            if sign > 0:
                todo.append((v, -1))
                todo += [(c, 1) for c in self.children[v]]
        self.tour, self.sign = np.array(tour).T
        self.enter = np.empty(len(self.edge), np.int64)
        self.enter[self.tour[self.sign > 0]] = np.flatnonzero(self.sign > 0)
        self.leaf = np.array([i for held in self.leaves for i in held])
        self.node = np.repeat(np.arange(len(self.edge)), [len(held) for held in self.leaves])
        self.size = np.array([len(sets[i]) for i in self.leaf])
        self.all_grams, self.set_start, _ = _flat([sets[i] for i in self.leaf], np.int64)

    def near(self, mark: np.ndarray, a: int, open_sets: np.ndarray, percent: int) -> np.ndarray:
        """Sets, among those of open_sets (a mask), that have their share in common with the marked set of a n-grams.

        The overlap with each path is summed along the tour, once for all sets that
        share it. With m n-grams of the path missing, a set of size x has x - m in
        common at most: that leaves subtrees out. The others are counted in full.
        """
        total = 100 + percent
        upto = np.concatenate([[0], np.cumsum(mark[self.grams])])
        hits = upto[self.end] - upto[self.start]
        common = np.cumsum(self.sign * hits[self.tour])[self.enter]
        missing = (self.upper_depth - common)[self.node]
        left = total * np.minimum(self.size - missing, a) >= percent * (a + self.size)
        at = np.flatnonzero(left & open_sets[self.leaf])
        n = self.size[at]
        upto = np.concatenate([[0], np.cumsum(mark[self.all_grams[_ranges(self.set_start[at], n)]])])
        ends = np.cumsum(n)
        return self.leaf[at[total * (upto[ends] - upto[ends - n]) >= percent * (a + n)]]


def _flat(rows: list, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows in one array, and where each starts and how long it is."""
    n = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([np.asarray(r, kind) for r in rows]) if len(rows) else np.zeros(0, kind)
    return flat, np.cumsum(n) - n, n


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Numbers start .. start + n - 1 of each pair, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(start - (ends - n), n)


def tree_links(sets: list[np.ndarray], groups: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that join all pairs of sets with 100 * common >= percent * union into the same
    components as all such pairs would; with two groups, pairs across them only.

    The numbers in a set follow one global order: n-grams of many sets first, so that
    sets share long beginnings. There is a tree for each size class. Each set
    walks the trees whose sizes fit, carries the overlap along the paths, and
    leaves out what cannot reach the share any more or is linked to it already.
    """
    values, count = np.unique(np.concatenate(sets), return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(values))
    local = [np.sort(rank[np.searchsorted(values, s)]).astype(">i8") for s in sets]
    across = len(set(groups)) > 1
    by_class: dict[int, list[int]] = {}
    for i, s in enumerate(local):
        if not across or groups[i] != 0:
            by_class.setdefault(int(np.log(len(s)) / np.log(CLASS)), []).append(i)
    trees = [_Tree(members, local) for members in by_class.values()]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    mark = np.zeros(len(values), bool)
    component = np.arange(len(sets))
    places = np.arange(len(sets))
    for done, i in enumerate(i for i in range(len(local)) if not across or groups[i] == 0):
        if done % 64 == 63:
            component = np.array([find(x) for x in range(len(sets))])
        a = len(local[i])
        mark[local[i]] = True
        open_sets = component != component[i] if across else (component != component[i]) & (places < i)
        for tree in trees:
            if 100 * tree.high[-1] < percent * a or 100 * a < percent * tree.low[-1]:
                continue
            for c in tree.near(mark, a, open_sets, percent).tolist():
                x, y = find(i), find(c)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((i, c))
        mark[local[i]] = False
    return links


def stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links to the smallest id of their component instead."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in list(root) if find(x) != x]


def _join(n: int, percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, _, _), part in rows.groupby(["family", "left", "right"], sort=False):
            ids, sides = part["doc_id"].to_numpy(), part["side"].tolist()
            sets = [ngrams(bytes(t), n) for t in part["text"]]
            out += stars([(int(ids[i]), int(ids[c])) for i, c in tree_links(sets, sides, percent)])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _marked(texts: DataFrame, members: DataFrame) -> DataFrame:
    """texts without most rows whose doc_id is not among members.

    The mark table has a fixed 2**BITS bits (2 MB) whatever the number of
    members. A full one lets all rows pass, which costs time and no result.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS)) + 1
    marks = members.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
    table = np.zeros((1 << BITS) // 8, np.uint8)
    for r in marks.collect():  # at most 2**BITS / 32768 rows of 4 KB
        table[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    sent = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = sent.value
        for pdf in batches:
            at = pdf["at"].to_numpy(np.int64)
            yield pdf.loc[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0, ["doc_id", "text"]].astype({"doc_id": "Int64"})

    return texts.withColumn("at", place - 1).mapInPandas(run, "doc_id long, text binary")


def near_classes(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A text's set holds its distinct runs of n words (ASCII letters in lower case);
    with fewer words the whole sequence, without words nothing. Rows whose sets
    have 100 * common >= percent * union are linked; component_id is the smallest
    doc_id reachable, the row's own for an empty set.

    1. Rows with equal sets form a class, represented by its smallest doc_id.
    2. In any global order of the n-grams, linked sets have two neighbours (three from
       a share of 85 % on, one below 75 %) in common among the first of each (prefix_length). Unlike a
       single n-gram, these hardly ever meet by chance or through a shared passage.
    3. Classes that share such neighbours at sizes within the share are
       candidates. Chains of candidates form families; no link leaves a family.
       Keys are shuffled once (candidate_links), a text's many copies with theirs.
    4. A family that fits a task is joined in one prefix tree. A larger one is
       cut by size class and hash into blocks, and every two blocks whose sizes
       can match meet in one task, so that no task holds a whole large family.
    5. Links join to components.

    Null text counts as empty. Rows with a null doc_id keep a null component and
    link nothing. Rows with one doc_id and different texts link through it. No
    rows give no rows. Other columns are not carried.
    """
    spark = docs.sparkSession
    python_workers(spark)
    free_shuffles(spark)
    texts = docs.select("doc_id", ascii_lower(whole(F.col("text"))).cast("binary").alias("text"))
    schema = "doc_id long, n long, d1 long, d2 long, keys array<long>"
    sets = staged(texts.mapInPandas(_prefixes(n, percent), schema))
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = staged(classes.withColumn("k", F.xxhash64("n", "d1", "d2")))

    size_class = F.floor(F.log("n") / F.lit(float(np.log(CLASS)))).cast("short")
    reach = int(np.ceil(np.log(100 / percent) / np.log(CLASS))) + 1
    keyed = sets.where("n > 0 AND doc_id IS NOT NULL").select(F.xxhash64("n", "d1", "d2").alias("k"), size_class.alias("c"), "keys")
    # many buckets find the same links: they are made distinct before they are stored
    families = staged(components(candidate_links(keyed, reach)))

    # linked sets are in one coarse size class or in neighbouring ones
    coarse = F.floor(F.log("n") / F.lit(float(np.log(100 / percent) * 1.001))).cast("int")
    members = classes.join(families.withColumnRenamed("node", "k"), "k")
    members = staged(members.select(F.col("rep").alias("doc_id"), "n", F.col("component").alias("family"), coarse.alias("c")))
    weight = members.groupBy("family").agg(F.sum("n").alias("w"))
    # blocks of a family: one if it fits a task, else by size class and hash
    blocks = members.groupBy("family", "c").agg(F.sum("n").alias("cw")).join(weight, "family")
    blocks = blocks.withColumn("cuts", F.ceil(F.col("cw") * 2 / TASK).cast("int")).withColumn("big", F.col("w") > TASK)
    blocks = staged(blocks.select("family", "c", "cuts", "big"))
    placed = members.join(blocks, ["family", "c"])
    fits = placed.where("NOT big").select("doc_id", "family", F.lit(0).cast("long").alias("left"), F.lit(0).cast("long").alias("right"), F.lit(0).alias("side"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")
    pieces = placed.where("big").select("doc_id", F.col("family").alias("f"), F.struct("c", part.alias("i")).alias("block"))
    cut = blocks.where("big").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    cut = cut.select("family", "c", F.struct("c", "i").alias("lo"))
    other = cut.select("family", F.explode(F.array(F.col("c") - 1, F.col("c"))).alias("c"), F.col("lo").alias("hi"))
    pairs = cut.join(other, ["family", "c"]).where(F.col("lo") <= F.col("hi"))
    pairs = staged(pairs.select("family", "lo", "hi", F.xxhash64("lo").alias("left"), F.xxhash64("hi").alias("right")))
    met = fits
    for side, end, of in ((0, "lo", pairs), (1, "hi", pairs.where("lo <> hi"))):
        joined = pieces.join(of, (F.col("f") == F.col("family")) & (F.col("block") == F.col(end)))
        met = met.unionByName(joined.select("doc_id", "family", "left", "right", F.lit(side).alias("side")))
    n_bins = max(64, int((weight.agg(F.sum("w")).first()[0] or 0) // (TASK // 8)))
    tasks = met.withColumn("bin", F.pmod(F.xxhash64("family", "left", "right"), F.lit(n_bins)))
    held = _marked(texts, members).join(tasks, "doc_id")
    links = held.groupBy("bin").applyInPandas(_join(n, percent), "a long, b long")
    linked = staged(components(links))

    out = sets.join(classes, ["n", "d1", "d2"], "left")
    out = out.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep"))
    out = out.join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs without the documents that have a linked document of smaller doc_id in their component."""
    found = near_classes(docs, n, percent)
    dropped = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")


def op10_jaccard_classes(spark, folder):
    return near_classes(documents(spark, folder).select("doc_id", "text"))
