"""Keyed Parquet tables that writers only append to.

An upsert adds its rows as one batch; readers take the newest row of each
key (merge on read). So a write costs what its batch costs: nothing of the
table is read or rewritten, and no file is moved by this code.

Layout under the table's path::

    _batch=000000000007-<token>/   one upsert or micro-batch (or several, packed)
    base=000000000005-<id>/        the collapsed table up to batch 5

* A batch is one partition of Spark's own dynamic partition overwrite: it
  appears as a whole or not at all, and a writer that comes again with the
  same token (a replayed micro-batch) replaces what it wrote before. Its
  number, also kept in each row as ``_seq``, orders the batches; one writer
  at a time.
* Newest means the largest ``_seq``. Keys compare with ``=``: a row with a
  NULL in its key never matches another, so all such rows are kept; ``_row``
  tells them apart.
* ``collapse`` writes the current rows as a new base, partitioned as wished,
  whose ``_SUCCESS`` marker (written last, by Spark) makes it valid. Readers
  use the newest valid base and the batches after it, so older folders no
  longer matter; ``vacuum`` deletes them, at any later time.
* ``compact`` packs small files of batches into bins. Until the packed
  inputs are deleted their rows exist twice, with the same ``_seq`` and
  ``_row``: readers see them once.

At each of these steps a driver can die: the table reads as before or as
after, and the next call goes on from there.
"""
from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from finlake.operators.dedup import latest
from finlake.sinks import fs
from finlake.sources.files import SourceMissing, file_inventory

log = logging.getLogger(__name__)

BATCH, SEQ, ROW = "_batch", "_seq", "_row"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SMALL = 0.75  # files under this share of the target size are packed
PER_GROUP = 10_000  # files packed against each other
PUSHED_KEYS = 100  # key sets up to this size are looked up by pushed predicates


def keyed(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _number(name: str) -> int:
    return int(name.split("=", 1)[1].split("-", 1)[0])


def _folders(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(bases, batches) by name, oldest first; a base without its marker is
    not finished and left out."""
    bases = [b for b in fs.folder_names(spark, path, "base=*") if fs.exists(spark, f"{path}/{b}/_SUCCESS")]
    return bases, fs.folder_names(spark, path, f"{BATCH}=*")


def _current(spark: SparkSession, path: str) -> tuple[str | None, list[str]]:
    """The valid base, if any, and the batches after it, as paths."""
    bases, batches = _folders(spark, path)
    since = _number(bases[-1]) if bases else 0
    return (f"{path}/{bases[-1]}" if bases else None), [f"{path}/{b}" for b in batches if _number(b) > since]


def exists(spark: SparkSession, path: str) -> bool:
    base, batches = _current(spark, path.rstrip("/"))
    return bool(base or batches)


def _with_own(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(SEQ, LongType()), StructField(ROW, LongType())])


def _data_schema(spark: SparkSession, base: str | None, batches: list[str], schema: StructType | None) -> StructType:
    if schema is None:
        found = spark.read.parquet(batches[-1] if batches else base).schema
        schema = StructType([f for f in found if f.name not in (SEQ, ROW)])
    return schema


def append(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    token: str | None = None,
    files: int | None = None,
) -> dict:
    """Add ``rows`` as one batch. ``token`` names the batch: a batch written
    under the same token before is replaced. Key columns get Bloom filters,
    so a later look-up of few keys skips most files. Rows are rebalanced to
    the session's advisory size, or dealt to ``files`` files."""
    path = path.rstrip("/")
    token = token or uuid.uuid4().hex
    bases, batches = _folders(spark, path)
    again = [b for b in batches if b.split("=", 1)[1].partition("-")[2] == token]
    number = _number(again[0]) if again else 1 + max([0, *map(_number, bases), *map(_number, batches)])
    written = Observation()
    out = rows.repartition(files) if files else rows.hint("rebalance")
    out = out.withColumns({
        SEQ: F.lit(number).cast("long"),
        ROW: F.when(~keyed(keys), F.monotonically_increasing_id()),
        BATCH: F.lit(f"{number:012d}-{token}"),
    }).observe(written, F.count(F.lit(1)).alias("rows"))
    _write_batch(out, path, keys)
    return {"batch": number, "rows_written": int(written.get["rows"]), "created": not bases and not batches}


def _with_filters(writer: DataFrameWriter, keys: Sequence[str]) -> DataFrameWriter:
    """Bloom filters on the key columns, sized by the keys a file has."""
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def _write_batch(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """All rows go to one folder: with a writer a folder Spark does not sort a
    task's rows by it, which would hold a whole packed file in memory."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH)
    conf = rows.sparkSession.conf
    old = conf.get(WRITERS)
    conf.set(WRITERS, "2")
    try:
        _with_filters(writer, keys).parquet(path)
    finally:
        conf.set(WRITERS, old)


def read(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """The current rows. Only the batches since the base are shuffled; the
    base meets their keys in an anti join (broadcast while they are small),
    and filters on its partition columns prune it."""
    path, keys = path.rstrip("/"), list(keys)
    base, batches = _current(spark, path)
    if not base and not batches:
        if schema is None:
            raise SourceMissing(path)
        return spark.createDataFrame([], schema)
    schema = _data_schema(spark, base, batches, schema)
    columns = schema.fieldNames()
    old = spark.read.schema(schema).parquet(base).select(*columns) if base else None
    if not batches:
        return old
    new = spark.read.schema(_with_own(schema)).parquet(*batches)
    known = new.filter(keyed(keys))
    # a key is at most once in a batch, so rows are dealt by key first: no task sorts a whole split of a packed file
    current = latest(known.repartition(*keys), keys, SEQ).select(*columns).unionByName(
        new.filter(~keyed(keys)).dropDuplicates([SEQ, ROW]).select(*columns))
    if old is None:
        return current
    replaced = known.select(*keys).dropDuplicates()
    kept = old.filter(keyed(keys)).join(replaced, keys, "left_anti").select(*columns)
    return current.unionByName(kept).unionByName(old.filter(~keyed(keys)))


def existing_keys(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                  schema: StructType | None = None) -> DataFrame:
    """The distinct keys of ``source`` that the table has. Few keys are
    pushed into the scan as equalities, where Parquet's Bloom filters and
    statistics skip files; many are semi-joined. Both read key columns alone."""
    path, keys = path.rstrip("/"), list(keys)
    wanted = source.filter(keyed(keys)).select(*keys).dropDuplicates()
    base, batches = _current(spark, path)
    if not base and not batches:
        return wanted.limit(0)
    schema = _data_schema(spark, base, batches, schema)
    parts = [spark.read.schema(schema).parquet(base)] if base else []
    parts += [spark.read.schema(schema).parquet(*batches)] if batches else []
    have = reduce(DataFrame.unionByName, [p.select(*keys) for p in parts])
    few = wanted.limit(PUSHED_KEYS + 1).collect()
    if len(few) <= PUSHED_KEYS:
        one = [reduce(lambda a, b: a & b, [F.col(k) == F.lit(r[k]) for k in keys]) for r in few]
        have = have.filter(reduce(lambda a, b: a | b, one)) if one else have.limit(0)
    else:
        have = have.join(wanted, keys, "left_semi")
    return have.dropDuplicates()


def collapse(spark: SparkSession, path: str, keys: Sequence[str], partition_cols: Sequence[str] = (),
             schema: StructType | None = None) -> dict:
    """Write the current rows as a new base and delete what it replaces.
    (A string partition column's '' and NULL are one folder to Spark.)"""
    path, parts = path.rstrip("/"), list(partition_cols)
    _, batches = _current(spark, path)
    if not batches:
        return {"batches": 0, "rows": 0}
    rows = read(spark, path, keys, schema)
    written = Observation()
    out = (rows.hint("rebalance", *parts) if parts else rows.hint("rebalance")).observe(written, F.count(F.lit(1)).alias("rows"))
    last = _number(batches[-1].rsplit("/", 1)[1])
    _with_filters(out.write.partitionBy(*parts) if parts else out.write, keys).parquet(f"{path}/base={last:012d}-{uuid.uuid4().hex}")
    vacuum(spark, path)
    return {"batches": len(batches), "rows": int(written.get["rows"])}


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders that the valid base has replaced."""
    path = path.rstrip("/")
    bases, batches = _folders(spark, path)
    if not bases:
        return 0
    since = _number(bases[-1])
    unfinished = [b for b in fs.folder_names(spark, path, "base=*") if b not in bases and _number(b) < since]
    gone = bases[:-1] + unfinished + [b for b in batches if _number(b) <= since]
    for name in gone:
        fs.delete(spark, f"{path}/{name}")
    return len(gone)


def _first_fit(files: pd.DataFrame, target: int) -> pd.DataFrame:
    """First-fit decreasing: each file, largest first, goes into the first
    bin with room."""
    files = files.sort_values(["length", "path"], ascending=[False, True])
    room: list[int] = []
    bins = []
    for size in files["length"]:
        at = next((k for k, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(target)
        room[at] -= size
        bins.append(at)
    return files.assign(bin=bins)


def plan_bins(files: DataFrame, target_file_bytes: int, min_input_files: int) -> DataFrame:
    """(path, length, rows, part, bin) of the small files of an inventory
    that share a bin with at least ``min_input_files`` - 1 others. Files are
    dealt to parts of about ``PER_GROUP``, each packed by one task."""
    small = files.filter(F.col("length") < int(SMALL * target_file_bytes))
    parts = max(1, small.count() // PER_GROUP)
    dealt = small.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int")).select("path", "length", "rows", "part")
    packed = dealt.groupBy("part").applyInPandas(
        lambda f: _first_fit(f, int(target_file_bytes)), "path string, length long, rows long, part int, bin int")
    full = packed.groupBy("part", "bin").count().filter(F.col("count") >= min_input_files).drop("count")
    return packed.join(full, ["part", "bin"], "left_semi").select("path", "length", "rows", "part", "bin")


def compact(spark: SparkSession, path: str, keys: Sequence[str], target_file_bytes: int, min_input_files: int,
            schema: StructType | None = None) -> dict:
    """Pack the small files of the batches into files of about the target
    size; large files stay as they are. What is reported is what was
    written. The chosen names come to the driver, as in any scan's file
    list."""
    path = path.rstrip("/")
    base, batches = _current(spark, path)
    nothing = {"files_before": 0, "files_after": 0, "rows": 0}
    if not batches:
        return nothing
    chosen = plan_bins(file_inventory(spark, *batches), target_file_bytes, min_input_files).collect()
    if not chosen:
        return nothing
    schema = _data_schema(spark, base, batches, schema)
    ids = {key: k for k, key in enumerate(sorted({(r["part"], r["bin"]) for r in chosen}))}
    bins = spark.createDataFrame([(r["path"], ids[r["part"], r["bin"]]) for r in chosen], "_file string, _bin int")
    files = [fs.from_uri(spark, r["path"]) for r in chosen]
    last = max(_number(f.rsplit("/", 2)[1]) for f in files)
    name = f"{last:012d}-packed-{uuid.uuid4().hex}"
    written = Observation()
    rows = spark.read.schema(_with_own(schema)).parquet(*files).withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.join(bins, "_file").repartitionById(len(ids), F.col("_bin")).drop("_file", "_bin")
    _write_batch(rows.withColumn(BATCH, F.lit(name)).observe(written, F.count(F.lit(1)).alias("rows")), path, keys)
    folder = f"{path}/{BATCH}={name}"
    expected, got = sum(r["rows"] for r in chosen), int(written.get["rows"])
    if got != expected:
        fs.delete(spark, folder)
        raise RuntimeError(f"packed {got} rows of {expected}; table left unchanged")
    after = file_inventory(spark, folder).count()
    packed = set(files)
    for b in batches:
        inside = {fs.from_uri(spark, f) for f in spark.read.schema(schema).parquet(b).inputFiles()}
        if inside <= packed:
            fs.delete(spark, b)
        else:
            for f in inside & packed:
                fs.delete(spark, f)
    log.info("packed %s files into %s", len(files), after)
    return {"files_before": len(files), "files_after": after, "rows": got}
