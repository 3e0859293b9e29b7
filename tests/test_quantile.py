"""Buckets found by counting against Spark's ntile."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from finlake.operators.quantile import ntiles

DDL = "id string, small int, big long, x double, one float"


def check(spark, rows, k=5):
    df = spark.createDataFrame(rows, DDL).repartition(3).cache()
    orders = {f"{c}_{'d' if d else 'a'}": (c, d) for c in ("small", "big", "x", "one") for d in (False, True)}
    first = lambda c, d: F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first()
    want = df.select("id", *[F.ntile(k).over(Window.orderBy(first(c, d), F.col("id").asc_nulls_first())).alias(n) for n, (c, d) in orders.items()])
    got = ntiles(df, k, orders, "id").select("id", *orders)
    assert dict(got.dtypes)["x_a"] == "int"
    assert {r["id"]: tuple(r)[1:] for r in got.collect()} == {r["id"]: tuple(r)[1:] for r in want.collect()}
    df.unpersist()


def rows_of(seed, n):
    rng = random.Random(seed)
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]
    return [(f"é{i * 7919 % 10007}x" if i else None, rng.choice([None, 1, 1, 1, 2, 9]), rng.choice([None, 2**62, 2**62 + 1, -2**63, 2**63 - 1, 0]),
             rng.choice(special) if rng.random() < 0.3 else rng.uniform(-1e3, 1e6), rng.choice([None, 0.5, 0.5, 7.25])) for i in range(n)]


@pytest.mark.parametrize("seed,n,k", [(1, 503, 5), (2, 700, 4), (3, 3, 5), (4, 1, 5), (5, 12, 1)])
def test_equals_ntile(spark, seed, n, k):
    check(spark, rows_of(seed, n), k)


def test_one_value_holds_a_third_and_long_common_prefixes(spark):
    rows = [("account-with-a-long-prefix-%06d" % i, 7 if i % 3 else i, i % 2, 1.0 if i % 3 else i / 7, None) for i in range(900)]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])
    with pytest.raises(ValueError):
        ntiles(spark.createDataFrame([], DDL), 0, {"a": ("x", False)}, "id")
    with pytest.raises(TypeError):
        ntiles(spark.createDataFrame(rows_of(1, 9), DDL), 2, {"a": ("id", False)}, "id")


def test_no_sort_and_no_exchange_of_rows(spark):
    df = spark.createDataFrame(rows_of(1, 50), DDL)
    plan = ntiles(df, 5, {"a": ("x", True), "b": ("small", False)}, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
