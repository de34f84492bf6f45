"""Fill-in-middle: cuts at line ends, sentinels in a byte buffer, blocks exchanged in place by three reversals."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import documents, python_workers, whole

# fixed values: the sentinels
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM = 7, 100, 50
CHUNK = 1 << 16  # bytes exchanged at once by a reversal
FRAME = "n long, form string, prefix_chars long, middle_chars long, output string"


def reverse(buffer: np.ndarray, start: int, end: int) -> None:
    """Reverse buffer[start:end] in place, a chunk from either end at a time."""
    while end - start > 1:
        size = min(CHUNK, (end - start) // 2)
        head, tail = buffer[start : start + size], buffer[end - size : end]
        kept = head[::-1].copy()
        head[:] = tail[::-1]
        tail[:] = kept
        start, end = start + size, end - size


def exchange(buffer: np.ndarray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, middle) and [middle, end) in place.
    exchange(buffer, start, start + end - middle, end) is the inverse."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def line_ends(data: bytes) -> np.ndarray:
    """Offsets after 0, 1, ... n lines; the last line may lack its line end."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
    last = [] if data.endswith(b"\n") or not data else [len(data)]
    return np.concatenate([[0], ends, last]).astype(np.int64)


def n_chars(data: bytes | memoryview) -> int:
    """Code points of UTF-8: every byte but the continuing ones."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def draws(seed: int, doc_id: str) -> list[int]:
    """h1 to h4 of a document."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def arrange(text: str, doc_id: str, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    data = text.encode("utf-8", "surrogatepass")
    ends = line_ends(data)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = int(ends[first]), int(ends[second])
    chars = n_chars(data[:a]), n_chars(data[a:b])
    # <P> prefix <M> middle <S> suffix, sentinels inserted from the back
    buffer = bytearray(data)
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    middle = len(PREFIX) + a
    suffix = middle + len(MIDDLE) + b - a
    form = "spm" if h4 % 100 < spm else "psm"
    exchange(np.frombuffer(buffer, np.uint8), middle if form == "psm" else 0, suffix, len(buffer))
    return n, form, *chars, buffer.decode("utf-8", "surrogatepass")


def restore(output: str, form: str) -> str:
    """The text that `arrange` was given: the blocks are exchanged back and the sentinels taken out."""
    if form == "plain":
        return output
    buffer = bytearray(output, "utf-8", "surrogatepass")
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    start, moved = (suffix, middle) if form == "psm" else (0, buffer.index(PREFIX))
    exchange(np.frombuffer(buffer, np.uint8), start, moved, len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at : at + len(sentinel)]
    return buffer.decode("utf-8", "surrogatepass")


def _as_text(number: Column) -> Column:
    return F.coalesce(number.cast("string"), F.lit(""))


def fill_in_middle(docs: DataFrame, out: str = "fim", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Add the struct `out` of n (lines), form, prefix_chars, middle_chars and output to every row.

    A document's draws depend on `seed` and doc_id alone; `rate` is the percentage of texts
    that are arranged, `spm` that of them in suffix-first form. Null and empty texts, and texts
    that hold a sentinel, stay plain: output is the text (null: empty), and the two
    lengths are null. A null id counts as an empty one. Repeated rows are arranged
    alike. A text of any length is one buffer. Other columns stay as they are;
    a column called `out` is an error. No rows give no rows.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    python_workers(docs.sparkSession)

    @F.pandas_udf(FRAME)
    def run(texts: pd.Series, ids: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame([arrange(t, i, seed, rate, spm) for t, i in zip(texts, ids)], columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return rows.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.withColumn(out, run(whole(F.col("text")), _as_text(F.col("doc_id"))))


def restored(df: DataFrame, fim: str = "fim", out: str = "restored") -> DataFrame:
    """Add the text rebuilt from the output and form of `fim`; a null output gives null."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    python_workers(df.sparkSession)

    @F.pandas_udf("string")
    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None else restore(o, f) for o, f in zip(outputs, forms)], dtype=object)

    return df.withColumn(out, run(F.col(f"{fim}.output"), F.col(f"{fim}.form")))


def op11_fill_in_middle(spark, folder):
    arranged = fill_in_middle(documents(spark, folder).select("doc_id", "text"))
    return restored(arranged).select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.encode("fim.output", "utf-8"), 256).alias("output_sha256"),
        F.sha2(F.encode("restored", "utf-8"), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
d AS (
  SELECT *, len(units)::BIGINT AS n,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
         array_to_string(units[b + 1:], '') AS suf
  FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
