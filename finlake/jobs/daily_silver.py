"""spark-submit job: raw transactions of one day -> silver table.

    spark-submit finlake/jobs/daily_silver.py --date 2024-01-15 \\
        --raw-path s3a://bucket/raw/transactions --target lake.finance.transactions_silver

Exit 0 on success, 1 on any failure (including a failed quality gate).
"""
from __future__ import annotations

import logging
import sys

from finlake.functions.dates import parse_date
from finlake.jobs import runner
from finlake.plans import silver
from finlake.sinks import log_table, maintenance
from finlake.sinks.upsert import is_path

log = logging.getLogger("finlake.daily_silver")


def main(argv: list[str] | None = None) -> int:
    p = runner.parser("Daily silver ETL")
    p.add_argument("--date", required=True, help="processing date YYYY-MM-DD")
    p.add_argument("--raw-path", required=True, help="folder holding date=YYYY-MM-DD/ sub-folders")
    p.add_argument("--target", required=True, help="catalog table name or Parquet path")
    p.add_argument("--compact", action="store_true", help="compact the table after the load")
    p.add_argument("--collapse", action="store_true", help="on a path: fold the loads so far into a partitioned base")
    args = p.parse_args(argv)
    day = parse_date(args.date)

    def body(spark):
        result = silver.run(spark, args.raw_path, args.target, day, provider=args.provider)
        if args.collapse and is_path(args.target):
            result["collapse"] = log_table.collapse(spark, args.target, silver.MERGE_KEYS, silver.PARTITION_COLS)
        if args.compact:
            result["maintenance"] = maintenance.compact_and_expire(spark, args.target, silver.MERGE_KEYS)
        log.info("silver load of %s done: %s", day, result)

    return runner.run(f"daily-silver-{day}", args, body)


if __name__ == "__main__":
    sys.exit(main())
