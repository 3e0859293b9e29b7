"""What Python workers hold between their tasks."""
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finlake.llm import collocations, decontam, simhash, token_files
from finlake.llm.common import lean, ship
from finlake.llm.queries import tokenizer_file


def held():
    """MB of this process that are in no file."""
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def test_free_memory_goes_back():
    kept, seen = [], []

    def run(batches):
        for b in batches:
            many = [bytes(2000) for _ in range(100_000)]
            kept.append(many[-1])  # the end of the heap stays in use
            seen.append(held())
            del many
            yield b

    batch = pa.RecordBatch.from_pydict({"a": [1]})
    before = held()
    assert list(lean(run)(iter([batch, batch]))) == [batch, batch]
    assert min(seen) > before + 150  # of both batches: what the first one freed did not add to the second
    assert max(seen) < before + 300 and held() < before + 60


def test_no_stage_of_the_proposals_has_two_python_steps(spark, monkeypatch):
    plans, with_all = [], collocations.Filter.with_all

    def seen(self, found):
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return with_all(self, found)

    monkeypatch.setattr(collocations.Filter, "with_all", seen)
    ship(spark)
    docs = spark.createDataFrame([("en", "a b c d. " * 5)], "lang string, text string")
    collocations.proposals(docs, 3, 1 << 12)
    assert len(plans) == collocations.MOST - 1
    assert not any("InArrow" in p for p in plans)


@pytest.fixture
def leaned(monkeypatch):
    """The names of the functions that ``lean`` was given."""
    names = []
    for module in (collocations, decontam, simhash, token_files):
        monkeypatch.setattr(module, "lean", lambda run: names.append(run.__name__) or lean(run))
    return names


def test_tasks_of_the_operators_give_memory_back(spark, leaned, tmp_dir):
    ship(spark)
    docs = spark.createDataFrame([(k, f"some words of text {k} " * 10, "en") for k in range(4)], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, "some words of text 1 some words")], "item_id long, text string")
    assert simhash.fingerprints(docs).count() == 4
    assert decontam.search(docs, items).count() == 4
    token_files.write(docs, f"{tmp_dir}/tokens", tokenizer_file())
    assert token_files.read(spark, f"{tmp_dir}/tokens").agg(F.count("*")).first()[0] == 4
    assert {"run", "count", "add", "fold", "ids", "blocks", "unpack"} <= set(leaned)
