"""D24 as files arrive: the net amounts by day, kept as keyed state.

The state is one entry for each day, the newest by fetch time, file name and
raw key (``net_feed_days``, a stateful aggregate here). Entries may come in any
order and any batches: an older one never replaces a newer one, and a late
correction does. A day is one row whatever the number of files, so every batch
publishes all days as a new version; a batch that is delivered again publishes
the same days again.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from possum.operators.assemble import net_feed_days
from possum.plans.publish import Manifest, commit, expire, read_manifest, read_published
from possum.sources.feed import stream_feed

DATASET = "net_feed"


def start_feed(spark: SparkSession, path: str, out_dir: str, stream_checkpoint: str,
               max_files: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Follow the feed files in ``path`` and publish their days in ``out_dir``."""
    def publish(days: DataFrame, batch_id: int) -> None:
        session = days.sparkSession
        before = read_manifest(session, out_dir) or Manifest(0, "")
        folder = os.path.join(out_dir, f"feed-{uuid.uuid4().hex}")
        days.coalesce(1).write.parquet(os.path.join(folder, DATASET))  # a row for each calendar day
        commit(session, out_dir, Manifest(before.version, folder, (DATASET,), applied={DATASET: batch_id}))
        expire(session, out_dir)

    stream = net_feed_days(stream_feed(spark, path, max_files))
    writer = stream.writeStream.outputMode("complete").option("checkpointLocation", stream_checkpoint).foreachBatch(publish)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_days(spark: SparkSession, out_dir: str) -> DataFrame:
    """The days as last published: day, net, raw, session_ok."""
    return read_published(spark, out_dir, DATASET, "parquet")
