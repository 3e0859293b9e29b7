import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from finlake.sinks import fs, log_table
from finlake.streaming import events


def _payload(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


GOOD = {
    "event_id": "1", "transaction_id": "t1", "account_id": "a1", "amount": 2.5,
    "currency": "eur", "event_type": "x", "event_time": "2024-01-02T03:04:05.123456",
}


def test_parse_edge_cases(spark):
    texts = [
        json.dumps(GOOD),
        json.dumps(GOOD)[:20],  # malformed
        "{}",
        "[1, 2]",
        None,
        json.dumps({**GOOD, "event_id": "2", "amount": "2.5"}),  # wrong type: amount NULL, row kept
        json.dumps({**GOOD, "event_id": "3", "extra": 1, "currency": None}),  # extra field, NULL currency
        json.dumps({**GOOD, "event_id": 4}),  # numeric id becomes a string
        json.dumps({**GOOD, "event_id": "5", "account_id": None}),  # required field missing
        json.dumps({**GOOD, "event_id": "6", "event_time": 1704067200}),  # epoch seconds
    ]
    out = {r["event_id"]: r for r in events.parse_events(_payload(spark, texts), dt.datetime(2024, 1, 1)).collect()}
    assert set(out) == {"1", "2", "3", "4", "6"}
    assert out["6"]["event_time"] == dt.datetime(2024, 1, 1)
    assert out["1"]["currency"] == "EUR" and out["1"]["event_time"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert out["1"]["transaction_date"] == dt.date(2024, 1, 2) and out["1"]["event_month"] == 1
    assert out["2"]["amount"] is None
    assert out["3"]["currency"] == "USD"


def test_in_batch_duplicates_collapse(spark):
    texts = [json.dumps(GOOD), json.dumps(GOOD), json.dumps({**GOOD, "event_time": "2024-01-03T00:00:00"})]
    out = events.parse_events(_payload(spark, texts)).collect()
    assert len(out) == 1 and out[0]["event_time"] == dt.datetime(2024, 1, 3)


def test_file_stream_restart_and_redelivery(spark, tmp_dir):
    inbox, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    first = [json.dumps({**GOOD, "event_id": str(i), "amount": float(i)}) for i in range(20)]
    _payload(spark, first).write.parquet(inbox)
    q = events.run(events.read_events(spark, path=inbox), target, ckpt, available_now=True)
    q.awaitTermination()
    assert events.read_target(spark, target).count() == 20
    # restart on the same checkpoint: old files are not processed again,
    # redelivered events overwrite the same rows
    again = [json.dumps({**GOOD, "event_id": str(i), "amount": 100.0 + i}) for i in range(5)]
    _payload(spark, again).write.mode("append").parquet(inbox)
    q = events.run(events.read_events(spark, path=inbox), target, ckpt, available_now=True)
    q.awaitTermination()
    rows = {r["event_id"]: r["amount"] for r in events.read_target(spark, target).collect()}
    assert len(rows) == 20 and rows["0"] == 100.0 and rows["19"] == 19.0


def test_parse_is_one_json_pass(spark):
    plan = events.parse_events(_payload(spark, [json.dumps(GOOD)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def drop(spark, inbox, first, n, **over):
    texts = [json.dumps({**GOOD, "event_id": str(i), "amount": float(i), **over}) for i in range(first, first + n)]
    _payload(spark, texts).repartition(3).write.mode("append").parquet(inbox)


def ingest(spark, inbox, target, ckpt):
    events.run(events.read_events(spark, path=inbox), target, ckpt, available_now=True).awaitTermination()


def test_stream_then_maintenance(spark, tmp_dir):
    from finlake.sinks import log_table, maintenance

    inbox, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    for batch in range(5):  # five drops, each a micro-batch appending a file
        drop(spark, inbox, 30 * batch, 30)
        ingest(spark, inbox, target, ckpt)
    read = lambda: sorted(tuple(r) for r in events.read_target(spark, target).drop("ingested_at").collect())
    before = read()
    assert len(before) == 150
    res = maintenance.compact(spark, target, events.MERGE_KEYS)
    assert res["files_before"] >= 5 and res["files_after"] == 1 and res["rows"] == 150
    assert read() == before
    log_table.collapse(spark, target, events.MERGE_KEYS, events.PARTITION_COLS, events.EVENT_TABLE)
    drop(spark, inbox, 140, 20, currency="vnd")  # ten known, ten new
    ingest(spark, inbox, target, ckpt)
    assert len(read()) == 160 and sum(r[4] == "VND" for r in read()) == 20


@pytest.mark.parametrize("when", ["before", "after"])
def test_killed_batch_is_replayed_once(spark, tmp_dir, monkeypatch, when):
    """The stream dies around the write of its second batch, before its
    checkpoint knows; the restart replays the batch under the same token."""
    inbox, target, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    drop(spark, inbox, 0, 20)
    ingest(spark, inbox, target, ckpt)
    drop(spark, inbox, 10, 20, currency="gbp")
    real = events.upsert

    def dying(*a, **kw):
        if when == "after":
            real(*a, **kw)
        raise OSError("killed")

    monkeypatch.setattr(events, "upsert", dying)
    with pytest.raises(Exception):
        ingest(spark, inbox, target, ckpt)
    monkeypatch.setattr(events, "upsert", real)
    ingest(spark, inbox, target, ckpt)
    got = {r["event_id"]: r["currency"] for r in events.read_target(spark, target).collect()}
    assert got == {str(i): "GBP" if i >= 10 else "EUR" for i in range(30)}
    assert len(fs.folder_names(spark, target, "_batch=*")) == 2  # replaced, not added
    drop(spark, inbox, 0, 1, currency="sgd")  # a new checkpoint starts with batch 0 again
    ingest(spark, inbox, target, f"{tmp_dir}/other")
    got = {r["event_id"]: r["currency"] for r in events.read_target(spark, target).collect()}
    assert len(got) == 30 and len(fs.folder_names(spark, target, "_batch=*")) == 3


def test_progress_rows_add_up_over_a_restart(spark, tmp_dir):
    from finlake.streaming.progress import ProgressTable, read_progress

    inbox, target, ckpt, path = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ckpt", f"{tmp_dir}/progress"
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        for first in (0, 40):
            drop(spark, inbox, first, 40)
            q = events.run(events.read_events(spark, path=inbox, max_files_per_trigger=1), target, ckpt, trigger_interval="100 milliseconds")
            deadline = time.time() + 90
            while time.time() < deadline and (events.read_target(spark, target).count() if log_table.exists(spark, target) else 0) < first + 40:
                time.sleep(0.5)
            q.processAllAvailable()
            q.stop()
        deadline = time.time() + 60  # progress events arrive a little later
        total = 0
        while time.time() < deadline and total != 80:
            time.sleep(0.5)
            if fs.exists(spark, path):
                total = read_progress(spark, path).agg(F.sum("input_rows")).first()[0]
    finally:
        spark.streams.removeListener(listener)
    assert total == 80
    kept = read_progress(spark, path).collect()
    assert len(kept) >= 4 and len({r["query_id"] for r in kept}) == 1 and len({r["run_id"] for r in kept}) == 2
    assert all(r["batch_ms"] > 0 and r["started_at"] is not None for r in kept)
