"""The spark-submit jobs, each in its own process (they stop their session)."""
import os
import subprocess
import sys

import pytest

from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(module, *args, timeout=600):
    env = {**os.environ, "PYTHONPATH": REPO}
    return subprocess.run(
        [sys.executable, "-m", module, *args], cwd=REPO, env=env, timeout=timeout,
        capture_output=True, text=True,
    )


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Raw versions of sf0.001 landed as date= folders (by a child process)."""
    base = str(tmp_path_factory.mktemp("cli"))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession, functions as F\n"
        "from finlake.sources import fixtures as fx\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false')"
        ".config('spark.sql.session.timeZone','UTC').getOrCreate()\n"
        "raw = fx.raw_only(fx.raw_transactions(s, %r))\n"
        "raw.filter(\"to_date(updated_at) = DATE'1998-03-02'\")"
        ".withColumn('date', F.date_format('updated_at','yyyy-MM-dd')).write.partitionBy('date').parquet(%r)\n"
    ) % (REPO, SF_SMALL, base + "/raw")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    return base


def test_daily_silver_and_reconcile_jobs(landed):
    r = _run("finlake.jobs.daily_silver", "--date", "1998-03-02", "--raw-path", landed + "/raw",
             "--target", landed + "/silver", "--collapse", "--compact",
             "--catalog", "spark.sql.sources.default=parquet", "--shuffle-partitions", "3")
    assert r.returncode == 0, r.stderr[-2000:]
    r = _run("finlake.jobs.customer_segments", "--snapshot-date", "1995-12-31", "--silver",
             landed + "/silver", "--target", landed + "/segments")
    assert r.returncode == 0, r.stderr[-2000:]
    # no source of truth for the month: skipped, exit 0
    r = _run("finlake.jobs.monthly_reconcile", "--year", "1998", "--month", "3", "--silver",
             landed + "/silver", "--sot-path", landed + "/sot", "--target", landed + "/rec")
    assert r.returncode == 0, r.stderr[-2000:]


def test_bad_date_exits_nonzero(landed):
    r = _run("finlake.jobs.daily_silver", "--date", "1998-02-30", "--raw-path", landed + "/raw",
             "--target", landed + "/silver2")
    assert r.returncode != 0


def test_event_stream_job_takes_its_settings_from_the_environment(landed):
    code = (
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "t = '{\"event_id\": \"1\", \"transaction_id\": \"t\", \"account_id\": \"a\", \"event_time\": \"2024-01-02T00:00:00\"}'\n"
        "s.createDataFrame([(bytearray(t.encode()),)], 'value binary').write.parquet(%r)\n"
    ) % (landed + "/inbox")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    os.environ.update(FINLAKE_STREAM_TARGET=landed + "/events", FINLAKE_STREAM_CHECKPOINT=landed + "/ckpt")
    try:
        r = _run("finlake.jobs.event_stream", "--input-path", landed + "/inbox", "--available-now", "--progress-path", landed + "/progress")
    finally:
        del os.environ["FINLAKE_STREAM_TARGET"], os.environ["FINLAKE_STREAM_CHECKPOINT"]
    assert r.returncode == 0, r.stderr[-2000:]
    assert len([d for d in os.listdir(landed + "/events") if d.startswith("_batch=")]) == 1


def test_bad_catalog_option_is_refused(landed):
    r = _run("finlake.jobs.monthly_reconcile", "--year", "1998", "--month", "3", "--silver", "x/y", "--sot-path", "x/z", "--target", "x/t", "--catalog", "nope")
    assert r.returncode == 2 and "nope" in r.stderr
