import datetime as dt

import pytest
from pyspark.sql import functions as F

from finlake.operators.merge import merge_counts, merge_rows
from finlake.sinks import log_table
from finlake.sinks.upsert import DuplicateKeyError, upsert

DDL = "k string, v int, day date"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_rows_new_changed_unchanged_null(spark):
    t = spark.createDataFrame([("a", 1, D1), ("b", 2, D1), (None, 3, D1)], DDL)
    s = spark.createDataFrame([("a", 10, D1), ("c", 30, D2), (None, 40, D2)], DDL)
    got = _rows(merge_rows(t, s, ["k"]))
    assert got == sorted([("a", 10, D1), ("b", 2, D1), (None, 3, D1), ("c", 30, D2), (None, 40, D2)], key=repr)
    c = merge_counts(t, s, ["k"]).first().asDict()
    assert c == {"target_rows": 3, "source_rows": 3, "rows_updated": 1, "rows_inserted": 2, "result_rows": 5}


def test_merge_idempotent(spark):
    t = spark.createDataFrame([("a", 1, D1), ("b", 2, D1)], DDL)
    s = spark.createDataFrame([("a", 10, D1), ("c", 30, D2)], DDL)
    once = merge_rows(t, s, ["k"])
    assert _rows(merge_rows(once, s, ["k"])) == _rows(once)


def test_merge_source_subset_of_columns(spark):
    t = spark.createDataFrame([("a", 1, D1)], DDL)
    s = spark.createDataFrame([("a", 5), ("b", 6)], "k string, v int")
    assert _rows(merge_rows(t, s, ["k"])) == sorted([("a", 5, D1), ("b", 6, None)], key=repr)


def test_two_target_rows_of_one_key_are_both_updated(spark):
    t = spark.createDataFrame([("a", 1, D1), ("a", 2, D2), ("b", 3, D1), (None, 4, D1)], DDL)
    s = spark.createDataFrame([("a", 10, D2), (None, 40, D2)], DDL)
    rows = merge_rows(t, s, ["k"])
    assert _rows(rows) == sorted([("a", 10, D2), ("a", 10, D2), ("b", 3, D1), (None, 4, D1), (None, 40, D2)], key=repr)
    c = merge_counts(t, s, ["k"]).first()
    assert (c["rows_updated"], c["rows_inserted"], c["result_rows"]) == (2, 1, rows.count())
    part = merge_rows(t, s.select("k", "v"), ["k"])
    assert _rows(part) == sorted([("a", 10, D1), ("a", 10, D2), ("b", 3, D1), (None, 4, D1), (None, 40, None)], key=repr)


def test_merge_on_two_keys_and_on_all_columns(spark):
    t = spark.createDataFrame([("a", 1, D1), ("a", 1, D2), ("a", None, D1)], DDL)
    s = spark.createDataFrame([("a", 1, D2), ("a", None, D1)], DDL)
    assert _rows(merge_rows(t, s, ["k", "v", "day"])) == sorted([("a", 1, D1), ("a", 1, D2), ("a", None, D1), ("a", None, D1)], key=repr)
    assert merge_rows(t, s, ["k", "v", "day"]).columns == t.columns


def test_null_keys_stay_out_of_the_joins(spark):
    t = spark.createDataFrame([("a", 1, D1)], DDL)
    plan = merge_rows(t, t, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnotnull(k") >= 3


def test_duplicate_source_key_rejected(spark, tmp_dir):
    s = spark.createDataFrame([("a", 1, D1), ("a", 2, D1)], DDL)
    with pytest.raises(DuplicateKeyError):
        upsert(spark, s, f"{tmp_dir}/t", ["k"], ["day"])


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_merge_rows(spark, tmp_dir, seed):
    import random

    rnd = random.Random(seed)
    days = [D1, D2, dt.date(2024, 1, 3), None]
    t_rows = [(f"k{i}", rnd.randint(0, 9), rnd.choice(days)) for i in range(40)]
    s_rows = [(f"k{i}", 100 + rnd.randint(0, 9), rnd.choice(days)) for i in rnd.sample(range(60), 25)]
    s_rows += [(None, 7, D1)]
    t = spark.createDataFrame(t_rows + [(None, 1, D2)], DDL)
    s = spark.createDataFrame(s_rows, DDL)
    path = f"{tmp_dir}/eq{seed}"
    assert upsert(spark, t, path, ["k"], ["day"]) == {"rows_inserted": 41, "rows_updated": 0, "created": True}
    res = upsert(spark, s, path, ["k"], ["day"])
    want = merge_rows(t, s, ["k"])
    assert _rows(log_table.read(spark, path, ["k"], t.schema)) == _rows(want)
    c = merge_counts(t, s, ["k"]).first()
    assert (res["rows_updated"], res["rows_inserted"]) == (c["rows_updated"], c["rows_inserted"])
    assert c["result_rows"] == want.count() == c["target_rows"] + c["rows_inserted"]


def test_upsert_of_key_only_rows(spark, tmp_dir):
    path = f"{tmp_dir}/keys"
    upsert(spark, spark.createDataFrame([("a",), ("b",)], "k string"), path, ["k"])
    r = upsert(spark, spark.createDataFrame([("b",), ("c",)], "k string"), path, ["k"])
    assert r["rows_updated"] == 1 and r["rows_inserted"] == 1
    assert sorted(x[0] for x in log_table.read(spark, path, ["k"]).collect()) == ["a", "b", "c"]


def test_namespace_and_provider_of_a_new_table(spark):
    name = "finlake_probe_ns.t"
    spark.sql("DROP NAMESPACE IF EXISTS finlake_probe_ns CASCADE")
    rows = spark.createDataFrame([("a", 1, D1)], DDL)
    assert upsert(spark, rows, name, ["k", "day"], ["day"], provider="orc")["created"]
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert about["Provider"].lower() == "orc" and [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["day"]
    spark.sql("DROP NAMESPACE finlake_probe_ns CASCADE")


def test_a_file_table_partitioned_by_keys_is_merged_by_partition(spark):
    name = "default.finlake_probe_parts"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    t = spark.createDataFrame([("a", 1, D1), ("b", 2, D1), ("a", 3, D2), ("n", 4, None)], DDL)
    assert upsert(spark, t, name, ["k", "day"], ["day"], provider="parquet")["created"]
    before = {r[0] for r in spark.table(name).filter(F.col("day") == F.lit(D2)).select(F.col("_metadata.file_path")).collect()}
    s = spark.createDataFrame([("a", 10, D1), ("c", 30, D1)], DDL)
    assert upsert(spark, s, name, ["k", "day"], ["day"]) == {"rows_inserted": 1, "rows_updated": 1, "created": False}
    assert _rows(spark.table(name)) == sorted([("a", 10, D1), ("b", 2, D1), ("c", 30, D1), ("a", 3, D2), ("n", 4, None)], key=repr)
    after = {r[0] for r in spark.table(name).filter(F.col("day") == F.lit(D2)).select(F.col("_metadata.file_path")).collect()}
    assert before == after  # the other partition's files are the same
    with pytest.raises(ValueError):  # a key could leave its partition
        upsert(spark, s, name, ["k"], ["day"])
    spark.sql(f"DROP TABLE {name}")
