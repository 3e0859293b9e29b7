import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from finlake.operators import quality
from finlake.plans import reconcile, segments, silver
from finlake.session import checkpoint_dir
from finlake.sinks import fs
from finlake.sinks.maintenance import read_table
from finlake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_silver_job_on_date_folders(spark, tmp_dir):
    raw = fx.raw_only(fx.raw_transactions(spark, SF_SMALL))
    raw_path = f"{tmp_dir}/raw"
    day = raw.select(F.date_format("updated_at", "yyyy-MM-dd").alias("d")).groupBy("d").count().orderBy(
        F.desc("count"), "d"
    ).first()["d"]
    # land the busiest day and its two neighbours: the job must read only its day
    d0 = dt.date.fromisoformat(day)
    near = [(d0 + dt.timedelta(days=k)).isoformat() for k in (-1, 0, 1)]
    landed = raw.withColumn("date", F.date_format("updated_at", "yyyy-MM-dd")).filter(F.col("date").isin(near))
    landed.write.partitionBy("date").parquet(raw_path)
    assert landed.select("date").distinct().count() >= 2
    target = f"{tmp_dir}/silver"
    res = silver.run(spark, raw_path, target, day, loaded_at=dt.datetime(2024, 1, 1))
    want = silver.transform(
        raw.filter(F.date_format("updated_at", "yyyy-MM-dd") == day), dt.datetime(2024, 1, 1)
    ).count()
    assert res["created"] and res["rows_inserted"] == want == res["rows"]
    # rerun: every row is an update, nothing new
    res2 = silver.run(spark, raw_path, target, day, loaded_at=dt.datetime(2024, 1, 2))
    assert res2["rows_updated"] == want and res2["rows_inserted"] == 0
    stored = read_table(spark, target, silver.MERGE_KEYS)
    assert stored.count() == want
    assert {r[0] for r in stored.select("_etl_loaded_at").distinct().collect()} == {dt.datetime(2024, 1, 2)}


def test_a_failing_gate_leaves_the_table_and_runs_the_plan_once(spark, tmp_dir, monkeypatch):
    raw = fx.raw_only(fx.raw_transactions(spark, SF_SMALL))
    raw.write.parquet(f"{tmp_dir}/raw")
    target = f"{tmp_dir}/silver"
    res = silver.run(spark, f"{tmp_dir}/raw", target, loaded_at=dt.datetime(2024, 1, 1))
    assert res["raw_rows"] == 6000 and res["rows"] == res["rows_inserted"]
    raw.withColumn("currency", F.lit("ZZZ")).write.parquet(f"{tmp_dir}/bad")
    real, runs = silver.transform, []
    monkeypatch.setattr(silver, "transform", lambda *a, **kw: runs.append(1) or real(*a, **kw))
    with pytest.raises(quality.QualityError):
        silver.run(spark, f"{tmp_dir}/bad", target, loaded_at=dt.datetime(2024, 1, 2))
    assert len(runs) == 1
    stored = read_table(spark, target, silver.MERGE_KEYS)
    assert {r[0] for r in stored.select("_etl_loaded_at").distinct().collect()} == {dt.datetime(2024, 1, 1)}
    assert len(fs.folder_names(spark, target, "_batch=*")) == 1
    scratch = checkpoint_dir(spark) + "/finlake-scratch"
    assert not fs.folder_names(spark, scratch, "silver-staged-*")  # deleted either way


def test_observed_counts_give_the_report(spark):
    df = silver.transform(fx.raw_transactions(spark, SF_SMALL), dt.datetime(2024, 1, 1), fx.TIE_BREAKERS)
    for rows in (df, df.drop("transaction_type", "has_currency_issue"), df.limit(0)):
        seen = Observation()
        rows.observe(seen, *quality.metrics(rows.columns)).write.format("noop").mode("overwrite").save()
        assert quality.report_of(spark, seen.get).collect() == quality.report(rows).collect()


def test_segments_and_reconcile_into_catalog_tables(spark, tmp_dir):
    spark.sql("DROP NAMESPACE IF EXISTS finlake_jobs_ns CASCADE")
    silver_df = silver.transform(fx.raw_transactions(spark, SF_SMALL), dt.datetime(2024, 1, 1), fx.TIE_BREAKERS).cache()
    name = "finlake_jobs_ns.segments"
    one = segments.run(spark, silver_df, name, "2001-07-31", provider="parquet")
    assert one["created"] and one["rows_inserted"] == 73
    other = segments.run(spark, silver_df, name, "2001-06-30", provider="parquet")
    again = segments.run(spark, silver_df, name, "2001-07-31", provider="parquet")
    assert (again["rows_inserted"], again["rows_updated"]) == (0, 73)
    by_day = {r[0].isoformat(): r[1] for r in spark.table(name).groupBy("snapshot_date").count().collect()}
    assert by_day == {"2001-07-31": 73, "2001-06-30": other["rows_inserted"]}
    fx.source_of_truth(silver_df).write.parquet(f"{tmp_dir}/sot/year=1998/month=03")
    for _ in range(2):
        rec = reconcile.run(spark, silver_df, f"{tmp_dir}/sot", "finlake_jobs_ns.reconcile", 1998, 3, provider="parquet")
    assert rec["accounts_checked"] == 9 == spark.table("finlake_jobs_ns.reconcile").count()
    silver_df.unpersist()
    spark.sql("DROP NAMESPACE finlake_jobs_ns CASCADE")


def test_segments_job(spark, tmp_dir):
    silver_df = silver.transform(fx.raw_transactions(spark, SF_SMALL), dt.datetime(2024, 1, 1), fx.TIE_BREAKERS)
    res = segments.run(spark, silver_df, f"{tmp_dir}/seg", "2001-07-31")
    # golden values of the survey at sf0.001
    assert res["segments"] == {
        "Champions": 8, "Loyal": 21, "Potential": 18, "At Risk": 14, "Lost": 10, "Needs Attention": 2,
    }
