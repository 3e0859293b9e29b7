"""spark-submit job: reconcile one month (G6). Exit 1 when discrepancies
were found, so the scheduler retries; a missing source of truth is a
skipped run (exit 0)."""
from __future__ import annotations

import logging
import sys

from finlake.jobs import runner
from finlake.plans import reconcile, silver
from finlake.sinks.maintenance import read_table

log = logging.getLogger("finlake.monthly_reconcile")


def main(argv: list[str] | None = None) -> int:
    p = runner.parser("Monthly reconciliation")
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--month", type=int, required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--sot-path", required=True, help="folder with year=YYYY/month=MM/ sub-folders")
    p.add_argument("--target", required=True)
    args = p.parse_args(argv)

    def body(spark):
        rows = read_table(spark, args.silver, silver.MERGE_KEYS)
        result = reconcile.run(spark, rows, args.sot_path, args.target, args.year, args.month, provider=args.provider)
        log.info("reconcile done: %s", result)
        return int(result["status"] == "failed")

    return runner.run(f"monthly-reconcile-{args.year}-{args.month:02d}", args, body)


if __name__ == "__main__":
    sys.exit(main())
