"""Contacts as a stream: each micro-batch is merged into the snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kontora import schema as S
from kontora.functions import contacts as C
from kontora.operators import ingest
from kontora.sources.tables import Snapshots


def upsert_stream(contacts: DataFrame, snapshots: Snapshots, checkpoint: str, **trigger) -> StreamingQuery:
    """Merge a stream of contacts (file_idx, row_idx, email, created) as it comes.

    A batch that is replayed after a failure would count twice, so the number of
    the last batch is kept beside the snapshots and older ones are skipped.
    """
    mark = Snapshots(snapshots.spark, snapshots.folder + "_batches", S.struct("batch bigint, version int"))

    def merge(batch: DataFrame, number: int) -> None:
        done = mark.read().agg({"batch": "max"}).first()[0]
        if done is not None and number <= done:
            return
        new = ingest.keep_newest(C.classify(ingest.first_wins(batch)))
        version = snapshots.write(ingest.upsert(snapshots.read(), new))
        mark.write(snapshots.spark.createDataFrame([(number, version)], mark.schema))

    return contacts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
