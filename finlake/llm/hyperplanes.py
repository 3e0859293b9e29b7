"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

The signs of a vector against ``bits`` random hyperplanes are its key in one
table. Two vectors at an angle a share a key with probability
(1 - a / pi) ** bits, so the number of tables follows from ``miss``: a pair
at exactly ``min_cosine`` shares no key in any table with that probability,
closer pairs with far less. ``bits`` grows with the logarithm of the number
of vectors, so the vectors that share a key by chance stay a small part at
every size.

Equal vectors are folded into one class first. Only rows of keys that
several classes share get their vectors; a key with more than ``block``
classes is cut into blocks and every pair of blocks is compared in a group
of its own, so a group is bounded however many classes share the key. Within
a group each pair's cosine is computed in double precision. A pair counts in
the first table in which it shares a key, so a link is counted once; what
leaves a task is a number of links and one star edge per class, never the
pairs. Signs are taken from integers whose products are exact, so every task
finds the same keys. Components are found by the large-star and small-star
steps of ``simhash.components``.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component link with nothing, not even with their own copies; vectors
of different lengths do not link; a null id is carried along and never the
smallest id, a component of null ids alone has a null component id; repeated
rows are vectors of their own and link; an empty table gives an empty
result; further columns do not matter.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from finlake.llm.common import stored
from finlake.llm.simhash import components

SEED = 11
SPARE_BITS = 3  # keys are longer than log2 of the number of vectors by this
FEW = 32  # groups up to this size are compared side by side
ROWS = 512  # vectors whose keys are made at a time


def tables_for(bits: int, min_cosine: float, miss: float) -> int:
    """Tables after which a pair at ``min_cosine`` is missed with
    probability ``miss``."""
    shared = (1 - math.acos(min_cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log1p(-shared))


def planes(size: int, bits: int, tables: int) -> np.ndarray:
    """Random hyperplanes with whole-number components, a column each."""
    normal = np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))
    return np.rint(normal * 1024)


def keys_of(x: np.ndarray, normals: np.ndarray, bits: int) -> np.ndarray:
    """(vectors, tables): the key of each vector in each table. Vectors are
    scaled by a power of two and rounded to whole numbers, so that the
    products are exact in any order of summation."""
    whole = np.rint(np.ldexp(x, 20 - np.frexp(np.abs(x).max(axis=1))[1][:, None]))
    signs = (whole @ normals > 0).reshape(len(x), -1, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def unit(x: np.ndarray) -> np.ndarray:
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(vectors: pa.ListArray, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _usable(v: Column) -> Column:
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~broken & F.exists(v, lambda x: x != 0), F.lit(False))


def _by_size(vectors: pa.ListArray) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.diff(vectors.offsets.to_numpy())
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def _keys(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(size, key, node): a row per class and table; the table is in the
    key's upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        upper = np.arange(tables, dtype=np.int64) << bits
        for b in batches:
            for size, rows in _by_size(b.column(1)):
                if size not in normals:
                    normals = {size: planes(size, bits, tables)}
                for at in range(0, len(rows), ROWS):
                    part = b.take(pa.array(rows[at:at + ROWS]))
                    keys = keys_of(matrix(part.column(1), size), normals[size], bits) + upper
                    node = np.repeat(part.column(0).to_numpy(), tables)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(node), size, np.int32)), pa.array(keys.ravel()), pa.array(node)],
                        ["size", "key", "node"])

    return classes.select("node", "v").mapInArrow(run, "size int, key long, node long")


def _pairs(start: np.ndarray, x: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of rows of one group with enough cosine; groups
    are runs of rows, ``start`` their first rows."""
    size = np.diff(np.append(start, len(x)))
    group = np.repeat(np.arange(len(start)), size)
    found = [np.empty((2, 0), np.int64)]
    few = np.flatnonzero((size <= FEW)[group])
    for step in range(1, min(FEW, int(size.max(initial=0)))):
        i = few[few + step < len(x)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[i], x[i + step]) >= min_cosine]
        found.append(np.stack([i, i + step]))
    for g in np.flatnonzero(size > FEW):
        own = x[start[g]:start[g] + size[g]]
        i, j = np.nonzero(np.triu(own @ own.T >= min_cosine, 1))
        found.append(np.stack([i, j]) + start[g])
    i, j = np.concatenate(found, axis=1)
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes with links (i, j): the smallest node each is linked to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _verify(batches: Iterator[pa.RecordBatch], min_cosine: float, bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (size, key, lo, hi), columns ``size key lo hi part
    node copies v`` -> (node, root, links) of the links that are first found
    under these keys."""
    normals: dict[int, np.ndarray] = {}

    def groups(b: pa.RecordBatch) -> np.ndarray:
        of = np.stack([b.column(k).to_numpy().astype(np.int64) for k in range(4)])
        return np.flatnonzero(np.append(True, (of[:, 1:] != of[:, :-1]).any(axis=0)))

    def links(b: pa.RecordBatch, size: int) -> pa.RecordBatch:
        if size not in normals:
            normals.clear()
            normals[size] = planes(size, bits, tables)
        x = matrix(b.column(7), size)
        table = b.column(1).to_numpy() >> bits
        lo, hi, part = (b.column(k).to_numpy() for k in (2, 3, 4))
        i, j = _pairs(groups(b), unit(x), min_cosine)
        new = (lo[i] == hi[i]) | (part[i] != part[j])  # two blocks: only what lies across them
        i, j = i[new], j[new]
        if len(i):  # leave out what shares a key in an earlier table
            used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            keys = keys_of(x[used], normals[size], bits)
            a, z = at[:len(i)], at[len(i):]
            alive = np.arange(len(i))
            for t in range(tables):
                alive = alive[(table[i[alive]] <= t) | (keys[a[alive], t] != keys[z[alive], t])]
            i, j = i[alive], j[alive]
        nodes, of = np.unique(b.column(5).to_numpy(), return_inverse=True)
        copies, n = b.column(6).to_numpy(), np.zeros(len(nodes), np.int64)
        np.add.at(n, of[i], copies[j])
        np.add.at(n, of[j], copies[i])
        root = nodes[_roots(len(nodes), of[i], of[j])]
        some = n > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.array(root[some]), pa.array(n[some])], ["node", "root", "links"])

    def whole(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for size, rows in _by_size(b.column(7)):
            yield links(b.take(pa.array(rows)) if len(rows) < b.num_rows else b, size)

    rest: pa.RecordBatch | None = None
    for b in batches:
        b = b if rest is None else pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        if not b.num_rows:
            continue
        last = int(groups(b)[-1])  # the last group may go on in the next batch
        rest = b.slice(last)
        if last:
            yield from whole(pa.Table.from_batches([b.slice(0, last)]).combine_chunks().to_batches()[0])
    if rest is not None and rest.num_rows:
        yield from whole(pa.Table.from_batches([rest]).combine_chunks().to_batches()[0])


def links(classes: DataFrame, min_cosine: float, miss: float, block: int) -> DataFrame:
    """(node, root, links) of classes (node, v, copies): summed over its rows,
    the vectors a node links to; its rows' roots join the components."""
    bits = max(8, math.ceil(math.log2(max(2, classes.count()))) + SPARE_BITS)
    tables = tables_for(bits, min_cosine, miss)
    keys = stored(_keys(classes, bits, tables), "hyperplane-keys")
    shared = keys.groupBy("size", "key").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / block).cast("int")
    rows = keys.join(shared, ["size", "key"]).withColumn(
        "part", F.pmod(F.xxhash64("node", "key"), blocks).cast("int")).select(
        "size", "key", "node", "part", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("size", "key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                       "part", "node")
    rows = rows.join(classes.select("node", "copies", "v"), "node").select(
        "size", "key", "lo", "hi", "part", "node", "copies", "v")
    group = ["size", "key", "lo", "hi"]
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        lambda it: _verify(it, min_cosine, bits, tables), "node long, root long, links long")


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.9, miss: float = 0.002, block: int = 512,
                    vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector: the other
    vectors it links with directly, the smallest id that links lead to, and
    whether that is its own."""
    v = F.col(vector)
    if not isinstance(vectors.schema[vector].dataType, ArrayType):
        raise TypeError(f"{vector} is not an array")
    if not isinstance(vectors.schema[vector].dataType.elementType, (FloatType, DoubleType)):
        v = v.cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).withColumn("usable", _usable(F.col("v")))
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), "v").alias("h2")]
    usable = rows.filter("usable")
    classes = stored(
        usable.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).select(
            F.monotonically_increasing_id().alias("node"), "first", "copies", *hashes, "v"), "hyperplane-classes")
    found = stored(links(classes, min_cosine, miss, block), "hyperplane-links")
    roots = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "hyperplane-roots")
    of_class = classes.drop("v").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(
        roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = of_class.groupBy("root").agg(F.min("first").alias("component_id"))
    named = of_class.join(smallest, "root").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = usable.select("vec_id", *hashes).join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
