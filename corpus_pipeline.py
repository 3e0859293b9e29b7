"""A corpus pipeline over ``documents``: quality rules, SimHash near-dedup,
benchmark decontamination, mixing sources to target weights, token files.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every stage's result as Parquet and reads it again, so
a lost executor costs at most a stage's tasks. All but the last stage return
the columns of ``documents``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import decontam, mixing, quality_rules, simhash, token_files
from finlake.llm.common import stored, table
from finlake.llm.queries import END_ID, tokenizer_file
from finlake.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    found = decontam.search(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hits") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0, 1 or 2 times) as the mix takes it."""
    return mixing.repeat(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; their index, read back."""
    path = scratch_path(spark, "pipeline-tokens")
    token_files.write(docs, path, tokenizer_file(), end=END_ID)
    return token_files.read(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
    ("token_files", tokens),
]

#: SVD retrieval, LCS and the tokenizer have no SQL form; tests/llm compares
#: run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
