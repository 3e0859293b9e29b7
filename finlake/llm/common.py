"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import checkpoint_dir, scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their
    Python workers import it, whatever folder they start in."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[2]
        name = str(Path(tempfile.mkdtemp(prefix="finlake-code-")) / "finlake_code")
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", root, "finlake"))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: it is computed
    once, later reads survive lost executors, and its lineage is cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Free memory of this process goes back to the system: a Python worker
    waits for its next task beside the executor's JVM, and what Arrow and the
    C library keep for later counts against the same limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's alone
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving free memory back after each batch
    that it reads and at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b
                give_back()

        yield from run(read())
        give_back()

    return task


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the session's shared checkpoint folder; its
    files go when the DataFrame is garbage collected."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def words(text: Column) -> Column:
    """The words of a text: maximal runs without space or \\t..\\r; a null
    text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, underscored until they clash with none of
    the table's own (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
