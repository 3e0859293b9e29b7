"""Batches are written without sorting their rows by the batch's folder."""
from pyspark.sql import DataFrameWriter

from finlake.sinks import log_table


def test_no_sort_by_the_folder(spark, tmp_dir, monkeypatch):
    seen, parquet = [], DataFrameWriter.parquet
    before = spark.conf.get(log_table.WRITERS)

    def written(self, *args, **kw):
        seen.append(int(spark.conf.get(log_table.WRITERS)))
        return parquet(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    rows = spark.range(100).selectExpr("cast(id % 60 as string) AS k", "id AS v").dropDuplicates(["k"])
    log_table.append(spark, rows, f"{tmp_dir}/t", ["k"], files=8)
    done = log_table.compact(spark, f"{tmp_dir}/t", ["k"], 1 << 27, 2)
    assert done["rows"] == 60 and done["files_before"] == 8 and done["files_after"] == 1
    assert len(seen) == 2 and min(seen) > 0 and spark.conf.get(log_table.WRITERS) == before
    assert log_table.read(spark, f"{tmp_dir}/t", ["k"]).select("k").distinct().count() == 60


def test_rows_are_dealt_by_key_before_they_are_sorted(spark, tmp_dir):
    log_table.append(spark, spark.range(9).selectExpr("id AS k", "id AS v"), f"{tmp_dir}/r", ["k"])
    log_table.append(spark, spark.range(5).selectExpr("id AS k", "-id AS v"), f"{tmp_dir}/r", ["k"])
    got = log_table.read(spark, f"{tmp_dir}/r", ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan[plan.rindex("Exchange hashpartitioning(k"):]
    assert sorted(map(tuple, got.collect())) == [(k, -k if k < 5 else k) for k in range(9)]
