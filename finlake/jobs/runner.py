"""What the spark-submit jobs share: options, session, exit code.

``--catalog key=value`` (repeatable) is the overlay for a table-format
catalog and its store, e.g. ``spark.sql.catalog.lake=...``; ``--provider`` is
the format that absent target tables are created in.
"""
from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession

from finlake import session


def _pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not sign or not key.startswith("spark."):
        raise argparse.ArgumentTypeError(f"{text!r} is not spark.<key>=<value>")
    return key, value


def parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--catalog", type=_pair, action="append", default=[], metavar="spark.KEY=VALUE")
    p.add_argument("--provider", default=None, help="table format of new catalog tables")
    return p


def run(name: str, args: argparse.Namespace, body: Callable[[SparkSession], int | None]) -> int:
    """Run ``body`` in a session of its own; its value (0 if None) is the
    exit code, 1 if it raises: the scheduler retries then."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = session.build(f"finlake-{name}", shuffle_partitions=args.shuffle_partitions, catalog=dict(args.catalog))
    try:
        return body(spark) or 0
    except Exception:  # noqa: BLE001
        logging.getLogger("finlake").exception("%s failed", name)
        return 1
    finally:
        spark.stop()
