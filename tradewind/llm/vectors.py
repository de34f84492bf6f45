"""Vectors in whole numbers, packed into blocks where they are read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import python_workers
from tradewind.session import staged

LONG = 2**63 - 1
BATCH_BYTES = 8 << 20  # packed blocks are large rows


def quantised(vectors: DataFrame, flag: Column | None = None) -> DataFrame:
    """vec_id, v = floor(256 * x) of each component (cut to a long), dim, flag. Vectors that are null, empty
    or hold a null or non-finite component are left out; a null id stays, a null flag is false."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    flag = F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size("embedding").alias("dim"), flag.alias("flag"))


@dataclass(frozen=True)
class Numbers:
    """How the components of a frame are stored, and how its sums can be formed exactly."""

    rows: int
    largest: int  # of the absolute values
    dim: int
    norm: int  # no inner product is larger

    @property
    def stored(self) -> str:
        return next(t for t, most in (("<i2", 2**15 - 1), ("<i4", 2**31 - 1), ("<i8", LONG)) if self.largest <= most)


def numbers(rows: DataFrame) -> Numbers:
    """Row count, largest component, dimension and norm: four values reach the driver."""
    # the one value without a positive counterpart counts as one less
    highest = F.array_max(F.transform("v", lambda x: F.abs(F.greatest(x, F.lit(-LONG)))))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, largest, dim, most = rows.agg(F.count("*"), F.max(highest), F.max("dim"), F.max(norm)).first()
    return Numbers(n, largest or 0, dim or 0, int((most or 0.0) * (1 + 2**-40)) + 1)


def blocks(rows: DataFrame, scale: Numbers, per_block: int, width: int | None = None) -> DataFrame:
    """Pack vectors into blocks of at most per_block, without a shuffle: every task packs what it reads.

    Returns (dim, block, part, ids, flags, m): the block's number, the number of
    the slice of `width` components (all in one by default), ids and flags of its rows
    (with slice 0 only), and the slice's components as a matrix. The frame is checkpointed,
    so a block keeps its number when an executor is lost.
    """
    spark = rows.sparkSession
    python_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    stored = scale.stored
    schema = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())), ("flags", pa.list_(pa.bool_())), ("m", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 20, 0
        held: dict[int, list] = {}
        n = 0

        def flush():
            nonlocal made, n
            out = []
            for dim, chunks in held.items():
                ids = [i for c in chunks for i in c[0]]
                flags = [f for c in chunks for f in c[1]]
                m = np.concatenate([c[2] for c in chunks])
                for i in range(0, len(ids), per_block):
                    for part in range(-(-dim // (width or dim))):
                        lo = part * (width or dim)
                        cut = np.ascontiguousarray(m[i : i + per_block, lo : lo + (width or dim)]).astype(stored)
                        own = slice(i, i + per_block) if part == 0 else slice(0, 0)
                        out.append({"dim": dim, "block": first + made, "part": part, "ids": ids[own], "flags": flags[own], "m": cut.tobytes()})
                    made += 1
            held.clear()
            n = 0
            return pa.RecordBatch.from_pylist(out, schema)

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            ids, flags = batch.column("vec_id").to_pylist(), batch.column("flag").to_pylist()
            flat = batch.column("v").flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                m = flat[starts[at][:, None] + np.arange(dim)]
                m = np.maximum(m, -LONG)
                held.setdefault(dim, []).append(([ids[i] for i in at], [flags[i] for i in at], m))
            n += len(ids)
            if n >= per_block:
                yield flush()
        if n:
            yield flush()

    tasks = max(-(-scale.rows // per_block), spark.sparkContext.defaultParallelism)
    packed = rows.select("vec_id", "v", "dim", "flag").coalesce(tasks).mapInArrow(pack, "dim int, block long, part int, ids array<long>, flags array<boolean>, m binary")
    return staged(packed)


def matrix(data: bytes, stored: str, dim: int, exact: bool) -> np.ndarray:
    """Rows of a block; whole numbers of any size if sums could leave a long."""
    m = np.frombuffer(data, stored).reshape(-1, dim)
    return m.astype(np.int64) if exact else m.astype(np.int64).astype(object)
