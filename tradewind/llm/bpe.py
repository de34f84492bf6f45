"""BPE encoding by backtracking over longest matches, decoding by an offset table."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import documents, python_workers, whole

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORDS = 400_000  # words, and token pairs, that a Python worker remembers
SUFFIX, LAST = "</w>", "\ue000"

# white space: ASCII, NEL, no-break space, and the space separators and line ends of Unicode
SPACE = r"\t-\r \x85\xa0" + f"{chr(0x1680)}{chr(0x2000)}-{chr(0x200A)}{chr(0x2028)}{chr(0x2029)}{chr(0x202F)}{chr(0x205F)}{chr(0x3000)}"


def _category(kind: str) -> str:
    """Ranges of the code points of a general category, for a character class."""
    out, start = [], None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


@lru_cache(maxsize=1)
def splitter() -> re.Pattern:
    """The split pattern of the vocabulary file, its classes spelled out: another Unicode
    version of the pattern library would cut words elsewhere."""
    letters, numbers = _category("L"), _category("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACE}{letters}{numbers}]+")


# the same for text that has no code point above U+024F after lower-casing
LETTERS, NUMBERS = rf"a-z\xaa\xb5\xba\xdf-\xf6\xf8-{chr(0x24F)}", r"0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\t-\r \x85\xa0{LETTERS}{NUMBERS}]+")
BEYOND_LATIN = re.compile(rf"[^\x00-{chr(0x24F)}]|[A-Z\xc0-\xd6\xd8-\xde]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class _Words(dict):
    """Ids of the words seen; a word that is not there is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if len(self) >= WORDS:
            self.clear()
        ids = self[word] = np.array(self.encode(word), dtype="<u4").tobytes()
        return ids


class WordBpe:
    """Byte-level BPE with word ends, as a vocabulary file describes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        # a token as a string of byte letters, with LAST behind the last one of a word
        form = {}
        for c in self.letters:
            form[c], form[c + SUFFIX] = c, c + LAST
        self.merged = {}
        for rank, (a, b) in enumerate(merges):
            form[a + b] = form[a] + form[b]
            self.merged[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.units = {}
        self.tokens = ahocorasick.Automaton()
        for name, spelt in form.items():
            i = self.vocab[name]
            units = re.findall(f"(?s)[^{LAST}]{LAST}?", spelt)
            self.units[i] = [self.vocab[u.replace(LAST, SUFFIX)] for u in units]
            self.tokens.add_word(spelt, (len(spelt), i))
        self.tokens.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words(self._word)

        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        table = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in table])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merge(self, ids: list[int]) -> list[int]:
        """The merges in their order, one by one; only for the short rows of the pair table."""
        ids = list(ids)
        while len(ids) > 1:
            found = [(self.merged[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merged]
            if not found:
                break
            _, k = min(found)
            ids[k : k + 2] = [self.merged[ids[k], ids[k + 1]][1]]
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the units of both tokens gives back just these two."""
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) >= WORDS:
                self.pairs.clear()
            self.pairs[key] = self.merge(self.units[a] + self.units[b]) == [a, b]
        return self.pairs[key]

    def _word(self, word: str) -> list[int]:
        """Ids of one word: the longest match at each place that suits the token before it, else
        shorter ones, else back to the token before. A place found to lead nowhere is not entered again."""
        spelt = "".join([self.letters[b] for b in word.encode()]) + LAST
        at: list[list[tuple[int, int]]] = [[] for _ in spelt]
        for end, (n, i) in self.tokens.iter(spelt):
            at[end - n + 1].append((n, i))  # by growing length
        closed, ids, starts, place = set(), [], [], 0
        tried = len(at[0])
        while place < len(spelt):
            while tried:
                n, i = at[place][tried - 1]
                if place + n not in closed and (not ids or self.compatible(ids[-1], i)):
                    break
                tried -= 1
            if tried:
                ids.append(i)
                starts.append((place, tried))
                place += n
                tried = len(at[place]) if place < len(spelt) else 0
            else:
                closed.add(place)
                ids.pop()
                place, tried = starts.pop()
                tried -= 1
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers; special tokens are found as such."""
        if self.cut and "<" in text and self.cut.search(text):
            parts = self.cut.split(text)
            return b"".join(
                np.array([self.special[p]], dtype="<u4").tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text).replace(chr(0x3A3), chr(0x3C3)).lower()  # no final sigma
        split = splitter() if BEYOND_LATIN.search(text) else LATIN_SPLIT
        return b"".join(map(self.words.__getitem__, split.findall(text)))

    def decode(self, ids: bytes) -> str:
        """Token names with blanks between them, cut from the table of all names."""
        ids = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        if not len(ids):
            return ""
        starts = self.offsets[ids]
        n = self.offsets[ids + 1] - starts
        ends = np.cumsum(n)
        where = np.arange(ends[-1]) + np.repeat(starts - (ends - n), n)
        return self.bytes[where[:-1]].tobytes().decode()


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    """One coder a Python worker."""
    return WordBpe(path)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the ids of whole texts (null: empty) as little-endian unsigned 32-bit integers.

    Every row is encoded by itself: ties, repeated rows, nulls in other columns
    and further columns make no difference; a column named like `ids` is
    replaced. No special tokens are added; their names in a text give their ids.
    """
    python_workers(df.sparkSession)

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        coder = loaded(vocabulary)
        return pd.Series([coder.encode(t) for t in texts])

    return df.withColumn(ids, run(whole(F.col(text))))


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the text of ids (null: none)."""
    python_workers(df.sparkSession)

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        coder = loaded(vocabulary)
        return pd.Series([coder.decode(r) for r in rows])

    return df.withColumn(text, run(F.coalesce(ids, F.lit(b""))))


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    coded = decode(encode(docs.select("doc_id", "text"), vocabulary=vocabulary), vocabulary=vocabulary)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_bpe(spark, folder):
    return digests(documents(spark, folder))
