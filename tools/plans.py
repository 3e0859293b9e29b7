"""Print the physical plan trees (operators only) of key catalogue queries.

usage: python tools/plans.py [sf_dir]
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from finlake.plans.catalogue import QUERIES  # noqa: E402

KEY = [
    "silver_transactions",
    "count_duplicates",
    "quality_report",
    "reconcile_compare",
    "rfm_scores_distributed",
    "merge_counts",
    "parse_events",
]


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|]*)(\*?\(?\d*\)?\s*)([A-Za-z][A-Za-z ]*?)(?=[\s\[(]|$)(.*)$", line)
        if not m:
            continue
        prefix, _, name, rest = m.groups()
        detail = ""
        if name.startswith("Exchange"):
            detail = " " + rest.strip().split(",")[0][:60]
        elif "Scan" in name:
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", rest)
            detail = f" PushedFilters=[{pushed.group(1)[:80]}]" if pushed and pushed.group(1) else ""
        elif name.startswith("WindowGroupLimit"):
            detail = " " + ("Partial" if "Partial" in rest else "Final")
        out.append(f"{prefix}{name.strip()}{detail}")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in KEY:
        print(f"### {name}\n```\n{tree(QUERIES[name](spark, sf))}\n```\n", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
