"""The appended table: replays, kills at each step, collapse, packing, look-ups."""
import os
import random

import pytest
from pyspark.sql import functions as F

from finlake.operators.merge import merge_rows
from finlake.sinks import fs, log_table
from finlake.sources.files import file_inventory

DDL = "k string, v int, day string"
KEYS = ["k"]


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "day").collect()), key=repr)


def frame(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def current(spark, path, **kw):
    return rows(log_table.read(spark, path, KEYS, **kw))


def batches_of(seed, n):
    rng = random.Random(seed)
    return [[(f"k{i}", 100 * b + i, rng.choice(["d1", "d2", None])) for i in rng.sample(range(30), 12)] + [(None, b, "d1")] for b in range(n)]


def test_three_batches_with_redeliveries_equal_merge_rows(spark, tmp_dir):
    path, want = f"{tmp_dir}/t", frame(spark)
    for b, data in enumerate(batches_of(1, 3)):
        for _ in range(2):  # each batch is delivered twice
            out = log_table.append(spark, frame(spark, *data), path, KEYS, token=f"b{b}")
        assert out["rows_written"] == 13 and out["batch"] == b + 1
        want = merge_rows(want, frame(spark, *data), KEYS)
    assert current(spark, path) == rows(want)
    assert len(fs.folder_names(spark, path, "_batch=*")) == 3


def test_a_late_replay_does_not_win_over_newer_batches(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    log_table.append(spark, frame(spark, ("a", 1, "d1")), path, KEYS, token="one")
    log_table.append(spark, frame(spark, ("a", 2, "d1")), path, KEYS, token="two")
    log_table.append(spark, frame(spark, ("a", 1, "d1")), path, KEYS, token="one")
    assert current(spark, path) == [("a", 2, "d1")]


def test_append_reads_nothing_of_the_table(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    log_table.append(spark, frame(spark, ("a", 1, "d1")), path, KEYS)
    monkeypatch.setattr(type(spark), "read", property(lambda s: pytest.fail("an append read the table")))
    log_table.append(spark, frame(spark, ("a", 2, "d1")), path, KEYS)


@pytest.mark.parametrize("empty_before", [True, False])
def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_dir, empty_before):
    path = f"{tmp_dir}/t"
    if not empty_before:
        log_table.append(spark, frame(spark, ("a", 1, "d1")), path, KEYS)
    bad = frame(spark, ("a", 2, "d1"), ("b", 0, "d1")).withColumn("v", F.expr("CAST(10 / v AS INT)"))
    with pytest.raises(Exception):
        log_table.append(spark, bad, path, KEYS, token="x")  # a task fails: division by zero
    assert current(spark, path, schema=bad.schema) == ([] if empty_before else [("a", 1, "d1")])
    log_table.append(spark, frame(spark, ("a", 2, "d1")), path, KEYS, token="x")
    assert current(spark, path) == [("a", 2, "d1")]


@pytest.mark.parametrize("step", ["base", "marker", "vacuum"])
def test_collapse_killed_at_each_step(spark, tmp_dir, monkeypatch, step):
    path = f"{tmp_dir}/t"
    for data in batches_of(2, 4):
        log_table.append(spark, frame(spark, *data), path, KEYS)
    want = current(spark, path)
    if step == "vacuum":  # the base is complete, nothing is deleted yet
        monkeypatch.setattr(log_table, "vacuum", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            log_table.collapse(spark, path, KEYS, ["day"])
        monkeypatch.undo()
    else:  # part of a base without its marker
        name = f"{path}/base={4:012d}-dead"
        log_table.read(spark, path, KEYS).limit(3).write.parquet(name)
        os.remove(f"{name}/_SUCCESS")
    assert current(spark, path) == want
    assert log_table.collapse(spark, path, KEYS, ["day"])["rows"] in (len(want), 0)
    assert current(spark, path) == want
    newer = frame(spark, ("k1", -1, "d9"), ("new", -2, None), (None, -3, "d1"))
    log_table.append(spark, newer, path, KEYS)
    log_table.vacuum(spark, path)
    assert current(spark, path) == rows(merge_rows(frame(spark, *want), newer, KEYS))
    assert log_table.collapse(spark, path, KEYS, ["day"])["batches"] == 1
    assert current(spark, path) == rows(merge_rows(frame(spark, *want), newer, KEYS))
    assert fs.folder_names(spark, path, "_batch=*") == [] and len(fs.folder_names(spark, path, "base=*")) >= 1


def test_base_is_pruned_by_a_filter_on_its_partition(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    log_table.append(spark, frame(spark, *[(f"k{i}", i, f"d{i % 4}") for i in range(40)]), path, KEYS)
    log_table.collapse(spark, path, KEYS, ["day"])
    log_table.append(spark, frame(spark, ("k1", -1, "d2")), path, KEYS)
    one = log_table.read(spark, path, KEYS).filter("day = 'd1'")
    assert rows(one) == sorted([(f"k{i}", i, "d1") for i in range(5, 40, 4)], key=repr)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def small_files(spark, path, seed=3):
    for data in batches_of(seed, 3):
        log_table.append(spark, frame(spark, *data), path, KEYS, files=4)


def test_packing_converges_and_leaves_large_files(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    big = spark.range(40_000).select(F.concat(F.lit("big"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("day"))
    log_table.append(spark, big, path, KEYS, files=1)
    small_files(spark, path)
    want = current(spark, path)
    before = {r["path"]: r["length"] for r in file_inventory(spark, path).collect()}
    target = 1 << 20
    large = {p for p, n in before.items() if n >= log_table.SMALL * target}
    assert len(large) == 1
    out = log_table.compact(spark, path, KEYS, target, 5)
    after = {r["path"] for r in file_inventory(spark, path).collect()}
    assert out["files_before"] == len(before) - 1 and out["files_after"] == len(after) - 1 == 1
    assert large <= after and out["rows"] == 3 * 13
    assert current(spark, path) == want
    assert log_table.compact(spark, path, KEYS, target, 5)["files_before"] == 0
    assert {r["path"] for r in file_inventory(spark, path).collect()} == after


def test_packing_killed_before_the_inputs_are_deleted(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    small_files(spark, path)
    want = current(spark, path)
    monkeypatch.setattr(fs, "delete", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        log_table.compact(spark, path, KEYS, 1 << 20, 5)
    monkeypatch.undo()
    assert current(spark, path) == want  # every row is there twice, and read once
    log_table.compact(spark, path, KEYS, 1 << 20, 5)
    assert current(spark, path) == want
    log_table.collapse(spark, path, KEYS)
    assert current(spark, path) == want


def test_bins_are_first_fit_decreasing(spark):
    import pandas as pd

    sizes = [70, 60, 50, 40, 30, 30, 10, 10]
    got = log_table._first_fit(pd.DataFrame({"path": [str(k) for k in range(8)], "length": sizes}), 100)
    assert got.groupby("bin")["length"].apply(list).tolist() == [[70, 30], [60, 40], [50, 30, 10, 10]]
    inv = spark.createDataFrame([(str(k), n, None, 1) for k, n in enumerate(sizes)], "path string, length long, modificationTime timestamp, rows long")
    assert {r["path"] for r in log_table.plan_bins(inv, 100, 4).collect()} == {"2", "4", "6", "7"} or log_table.plan_bins(inv, 100, 4).count() == 4


def rows_scanned(df):
    """Rows that the plan's scans gave out."""
    df._jdf.queryExecution().toRdd().count()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        if "Scan parquet" in p.nodeName():
            n += p.metrics().apply("numOutputRows").value()
    return n


def test_few_keys_are_looked_up_through_bloom_filters(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    data = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").cast("int").alias("v"), F.lit("d").alias("day"))
    log_table.append(spark, data, path, KEYS, files=10)
    wanted = data.filter("v IN (7, 12345)").select("k").unionByName(spark.createDataFrame([("zz",), (None,)], "k string"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = log_table.existing_keys(spark, path, wanted, KEYS)
        many = log_table.existing_keys(spark, path, data.limit(500), KEYS)
        assert rows_scanned(found) <= 4_000 < 20_000 <= rows_scanned(many)  # two of ten files
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert found.count() == 2 and many.count() == 500
    assert log_table.existing_keys(spark, f"{tmp_dir}/none", wanted, KEYS).count() == 0


def test_odd_batches(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert current(spark, path, schema=frame(spark).schema) == []
    log_table.append(spark, frame(spark), path, KEYS)  # nothing to write, no folder
    assert not log_table.exists(spark, path)
    log_table.append(spark, frame(spark, (None, 1, ""), (None, 1, "")), path, KEYS)
    assert current(spark, path) == [(None, 1, ""), (None, 1, "")]
    assert log_table.collapse(spark, f"{tmp_dir}/none", KEYS) == {"batches": 0, "rows": 0}
