"""A dimension kept up to date from a stream of source rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.dedupe import latest_per_key
from tradewind.operators.upsert import upsert_scd1
from tradewind.sources.versions import VersionedTable


def batch_upsert(
    table: VersionedTable, name: str, bk: str, sk: str, attrs: Sequence[str], stamps: Sequence[str], now: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """Handler of a stream's batches: the newest row of every key is upserted.

    The batch's number is committed together with the table, so a batch that is
    delivered again, after a failure between the two commits of table and
    stream, changes nothing.  Rows without a key are left out.
    """

    def handle(batch: DataFrame, number: int) -> None:
        token = f"{name}:{number}"
        if table.has(token):
            return
        newest = latest_per_key(batch.where(F.col(bk).isNotNull()), [bk], stamps)
        frame = upsert_scd1(table.read(), newest, bk, sk, attrs, now if now is not None else F.current_timestamp())
        table.replace(frame, token)

    return handle


def upsert_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], progress: str) -> StreamingQuery:
    """Process what the source holds now, batch by batch, and stop; `progress` is the stream's checkpoint folder."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
