import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from finlake.operators.dedup import count_duplicates, duplicate_count, exact, latest

SCHEMA = StructType(
    [StructField("tx_id", StringType()), StructField("value", StringType()), StructField("updated_at", TimestampType())]
)


def test_latest_over_shuffled_versions(spark):
    """Versions arrive in any order; each key's last one is left."""
    versions = [(f"k{k}", f"{k}:{v}", dt.datetime(2023, 5, 1 + v)) for k in range(4) for v in range(k + 1)]
    df = spark.createDataFrame(versions[::2] + versions[1::2][::-1], SCHEMA)
    assert {r["value"] for r in latest(df, ["tx_id"], "updated_at").collect()} == {"0:0", "1:1", "2:2", "3:3"}


def test_duplicate_count_is_rows_beyond_the_first(spark):
    df = spark.range(12).selectExpr("concat('k', cast(sqrt(id) as int)) AS tx_id")  # 1, 3, 5 and 3 rows a key
    assert duplicate_count(df, ["tx_id"]) == 8


def test_count_duplicates_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "tx_id string")
    assert duplicate_count(df, ["tx_id"]) == 1
    assert duplicate_count(df.limit(0), ["tx_id"]) == 0


def test_null_timestamp_ranks_last_and_survives(spark):
    df = spark.createDataFrame(
        [("a", "null-ts", None), ("a", "dated", dt.datetime(2024, 1, 1)), ("b", "only-null", None), (None, "x", None)],
        SCHEMA,
    )
    out = {r["tx_id"]: r["value"] for r in latest(df, ["tx_id"], "updated_at").collect()}
    assert out == {"a": "dated", "b": "only-null", None: "x"}


def test_tie_breakers_make_ties_deterministic(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", "v1", ts), ("a", "v3", ts), ("a", "v2", ts)], SCHEMA)
    assert latest(df, ["tx_id"], "updated_at", ["value"]).first()["value"] == "v3"
    assert latest(df, ["tx_id"], "updated_at", [F.col("value").asc()]).first()["value"] == "v1"


def test_two_id_columns(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", "y", 1)], "k1 string, k2 string, ts int"
    )
    assert latest(df, ["k1", "k2"], "ts").count() == 2


def test_exact_whole_row_and_subset(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    assert exact(df).count() == 2
    assert exact(df, []).count() == 2
    assert exact(df, ["k"]).count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 100)), min_size=0, max_size=40))
def test_latest_properties(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, tie int") if rows else spark.createDataFrame([], "k int, ts int, tie int")
    once = latest(df, ["k"], "ts", ["tie"])
    got = sorted(tuple(r) for r in once.collect())
    # one row per key, and it is the maximum (ts, tie)
    best = {}
    for k, ts, tie in rows:
        best[k] = max(best.get(k, (ts, tie)), (ts, tie))
    assert got == sorted((k, ts, tie) for k, (ts, tie) in best.items())
    # idempotent
    assert sorted(tuple(r) for r in latest(once, ["k"], "ts", ["tie"]).collect()) == got
    # surplus rows = rows - distinct keys
    assert count_duplicates(df, ["k"]).first()[0] == len(rows) - len({r[0] for r in rows})


def test_latest_plan_limits_before_the_shuffle(spark):
    df = spark.range(0, 100).selectExpr("CAST(id % 7 AS STRING) AS k", "id AS ts")
    plan = latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
