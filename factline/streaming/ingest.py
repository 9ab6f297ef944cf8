"""Landed payload files as a stream: every micro-batch goes through the same run.

Rules that need the whole payload as evidence see it, since a file is one row.  A batch that comes
again after a failure finds its observations recorded and changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from factline.plans.pipeline import ingest
from factline.sources.bronze import observations
from factline.sources.store import Lake


def follow(lake: Lake, folder: str, checkpoint: str, max_files: int = 1000, **trigger) -> StreamingQuery:
    files = lake.spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True).text(folder)

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            ingest(lake, observations(df.select("value")), "stream")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
