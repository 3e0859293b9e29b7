"""Progress of the event stream as a table.

A listener keeps one row per micro-batch that had input: its rows, how long
it took and how far the source is ahead. A row is its own partition (query,
batch), written by Spark's dynamic partition overwrite, so a batch that is
replayed after a restart is counted once.
"""
from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

PROGRESS = ("run_id string, started_at timestamp, input_rows long, batch_ms long, rows_per_second double, "
            "backlog string, query_id string, batch_id long")


class ProgressTable(StreamingQueryListener):
    """Writes to ``path``; register it with ``spark.streams.addListener``.
    An error in here is logged, it does not stop the stream."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        log.info("stream %s started, run %s", event.id, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        backlog = {s.description: dict(s.metrics) for s in p.sources if s.metrics}
        row = (str(p.runId), dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")), int(p.numInputRows),
               int(p.batchDuration), float(p.processedRowsPerSecond), json.dumps(backlog) if backlog else None,
               str(p.id), int(p.batchId))
        try:
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("query_id", "batch_id").parquet(self.path)
        except Exception:  # noqa: BLE001 - progress rows must not end the ingest
            log.exception("progress of batch %s not kept", p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("stream %s ended: %s", event.id, event.exception or "no error")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)
