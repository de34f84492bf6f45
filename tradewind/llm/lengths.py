"""Token counts: an exact histogram of encoded lengths answers every context limit."""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import documents, prefix_sums, python_workers, whole
from tradewind.session import staged

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_length(df: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the number of tokens of whole texts; null has none."""
    python_workers(df.sparkSession)

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        coder = encoding(vocabulary)
        return pd.Series([len(coder.encode_ordinary(t)) for t in texts], dtype="int64")

    return df.withColumn(out, run(whole(F.col(text))))


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per encoded length: n_tokens, n_docs, and over all documents

    docs_at_least, tokens_at_least: documents at least that long, and their tokens;
    tokens_truncated: what a context limit of n_tokens leaves of the whole corpus;
    quantile: share of documents that are at most that long.

    Null and empty texts have length 0; every row counts, repeated ones too, and
    doc_id and other columns play no part. No rows give no rows. The sums run
    over lengths, not documents, in ranges of 1024 lengths.
    """
    counted = with_length(docs.select("text"), vocabulary=vocabulary).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counted = staged(
        counted.withColumns({"_all": F.lit(1), "_tokens": F.col("n_tokens") * F.col("n_docs")})
    )
    total = counted.agg(F.sum("n_docs"), F.sum("_tokens")).first()
    n_docs, n_tokens = int(total[0] or 0), int(total[1] or 0)
    summed = prefix_sums(
        counted, ["_all"], F.shiftright("n_tokens", 10), ["n_tokens"], {"docs_below": "n_docs", "tokens_below": "_tokens"}
    )
    at_least = F.lit(n_docs) - F.col("docs_below")
    return summed.select(
        "n_tokens",
        "n_docs",
        at_least.alias("docs_at_least"),
        (F.lit(n_tokens) - F.col("tokens_below")).alias("tokens_at_least"),
        (F.col("tokens_below") + at_least * F.col("n_tokens")).alias("tokens_truncated"),
        ((F.col("docs_below") + F.col("n_docs")) / F.lit(float(max(1, n_docs)))).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Per context limit: documents longer than it, and the tokens that it leaves."""
    asked = hist.select("n_tokens", "n_docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context"))
    longer = F.col("n_tokens") > F.col("context")
    return asked.groupBy("context").agg(
        F.sum(F.when(longer, F.col("n_docs")).otherwise(0)).alias("docs_cut"),
        F.sum(F.least("n_tokens", "context") * F.col("n_docs")).alias("tokens_kept"),
    )


def length_at(hist: DataFrame, share: float) -> int | None:
    """Smallest length that at least this share of the documents does not exceed."""
    return hist.where(F.col("quantile") >= share).agg(F.min("n_tokens")).first()[0]


def op7_length_histogram(spark, folder):
    return histogram(documents(spark, folder))
