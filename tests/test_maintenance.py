from finlake.sinks import log_table, maintenance
from finlake.sources.files import file_exists, file_inventory

DDL = "k long, v string"


def test_compact_then_expire_on_a_path(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.createDataFrame([(i, f"v{i}") for i in range(400)], DDL)
    log_table.append(spark, df, path, ["k"], files=8)
    res = maintenance.compact_and_expire(spark, path, ["k"])
    assert res == {"files_before": 8, "files_after": 1, "rows": 400, "expire": {"procedure": None, "folders_deleted": 0}}
    assert maintenance.compact(spark, path, ["k"])["files_before"] == 0
    assert maintenance.read_table(spark, path, ["k"]).count() == 400


def test_read_table_of_a_plain_folder(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/plain")
    assert maintenance.read_table(spark, f"{tmp_dir}/plain", ["id"]).count() == 5


def test_inventory_is_one_scan_without_columns(spark, tmp_dir):
    path = f"{tmp_dir}/many"
    spark.range(300).repartition(30).write.parquet(path)
    inv = file_inventory(spark, path)
    assert inv.count() == 30 and inv.agg({"rows": "sum"}).first()[0] == 300
    assert {r["length"] > 0 and r["modificationTime"] is not None for r in inv.collect()} == {True}
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_missing_and_present_files(spark, tmp_dir):
    assert file_inventory(spark, f"{tmp_dir}/nope").count() == 0
    assert not file_exists(spark, f"{tmp_dir}/nope")
    with open(f"{tmp_dir}/a.txt", "w") as f:
        f.write("x")
    assert file_exists(spark, f"{tmp_dir}/a.txt") and not file_exists(spark, f"{tmp_dir}/b.txt")
