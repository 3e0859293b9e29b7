"""spark-submit job: event stream -> keyed table.

Settings come from arguments (environment variables as defaults):
FINLAKE_KAFKA_BOOTSTRAP, FINLAKE_TOPIC, FINLAKE_STREAM_TARGET,
FINLAKE_STREAM_CHECKPOINT. Without Kafka, ``--input-path`` reads a folder
of Parquet files with a ``value`` column. ``--progress-path`` keeps a row per
micro-batch (input rows, times, backlog).
"""
from __future__ import annotations

import os
import sys

from finlake.jobs import runner
from finlake.streaming import events
from finlake.streaming.progress import ProgressTable


def main(argv: list[str] | None = None) -> int:
    env = os.environ.get
    p = runner.parser("Event stream ingest")
    p.add_argument("--bootstrap", default=env("FINLAKE_KAFKA_BOOTSTRAP"))
    p.add_argument("--topic", default=env("FINLAKE_TOPIC"))
    p.add_argument("--input-path", default=None)
    p.add_argument("--target", default=env("FINLAKE_STREAM_TARGET"), required=env("FINLAKE_STREAM_TARGET") is None)
    p.add_argument("--checkpoint", default=env("FINLAKE_STREAM_CHECKPOINT"), required=env("FINLAKE_STREAM_CHECKPOINT") is None)
    p.add_argument("--trigger", default=events.TRIGGER_INTERVAL)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--progress-path", default=None)
    args = p.parse_args(argv)

    def body(spark):
        if args.progress_path:
            spark.streams.addListener(ProgressTable(spark, args.progress_path))
        kafka = {"kafka.bootstrap.servers": args.bootstrap, "subscribe": args.topic} if args.bootstrap and args.topic else None
        stream = events.read_events(spark, kafka_options=kafka, path=args.input_path)
        events.run(stream, args.target, args.checkpoint, args.trigger, args.available_now, args.provider).awaitTermination()

    return runner.run("event-stream", args, body)


if __name__ == "__main__":
    sys.exit(main())
