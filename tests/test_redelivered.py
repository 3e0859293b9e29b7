"""The redelivered batches are collapsed once, not at each delivery."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.plans import catalogue  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


def test_deliveries_read_what_was_landed(spark, monkeypatch):
    plans, upsert = [], catalogue.upsert

    def delivered(session, source, *args, **kw):
        plans.append(source._jdf.queryExecution().optimizedPlan().toString())
        return upsert(session, source, *args, **kw)

    monkeypatch.setattr(catalogue, "upsert", delivered)
    got = catalogue.q_upsert_redelivered(spark, SF_SMALL)
    assert len(plans) == 7 and not any("Join" in p or "Window" in p for p in plans)
    target, source = catalogue._merge_sides(spark, SF_SMALL)
    want = catalogue.merge_rows(target, source, catalogue.MERGE_KEYS).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
