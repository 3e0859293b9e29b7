"""spark-submit job: RFM segments for one snapshot."""
from __future__ import annotations

import logging
import sys

from finlake.functions.dates import parse_date
from finlake.jobs import runner
from finlake.operators.rfm import DEFAULT_LOOKBACK_DAYS
from finlake.plans import segments, silver
from finlake.sinks.maintenance import read_table

log = logging.getLogger("finlake.customer_segments")


def main(argv: list[str] | None = None) -> int:
    p = runner.parser("Customer segmentation (RFM)")
    p.add_argument("--snapshot-date", required=True)
    p.add_argument("--lookback-days", type=int, default=DEFAULT_LOOKBACK_DAYS)
    p.add_argument("--silver", required=True, help="silver catalog table or Parquet path")
    p.add_argument("--target", required=True, help="segments catalog table or Parquet path")
    p.add_argument("--scoring", choices=["literal", "high_is_best"], default="literal")
    args = p.parse_args(argv)
    snap = parse_date(args.snapshot_date)

    def body(spark):
        rows = read_table(spark, args.silver, silver.MERGE_KEYS)
        log.info("segments done: %s", segments.run(
            spark, rows, args.target, snap, args.lookback_days, args.scoring, provider=args.provider))

    return runner.run(f"customer-segments-{snap}", args, body)


if __name__ == "__main__":
    sys.exit(main())
