"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits, one per majority over the XXH64 values of a
text's word shingles. Two fingerprints link at ``max_distance`` (3) or fewer
differing bits. On the ring of eight 8-bit segments the pigeonring
principle says: if all segments together differ in at most 3 bits, there
is a segment from which every chain of l consecutive segments differs in at
most l * 3 / 8 bits: none in the first two, at most one in the first five,
at most two in the first seven. The first five make the index key: two
segments exact and, as one difference lies in one of the next three, the two
others exact: 8 starts x 3 left-out segments, 32 bits each. A shared key is
a candidate; the chains of six and seven and the full distance are checked
after that.

Copies share a fingerprint and are folded into one before any join. A key
shared by more than ``bucket`` different fingerprints is not joined with
itself: its fingerprints are cut finer, 16 segments of 4 bits of which any
13 must agree (560 keys), and a group then holds at most 4096 different
fingerprints by construction; each is linked within its task without
emitting all pairs. No link is lost either way. Components are found by
alternating large-star and small-star steps, each cut by a checkpoint.

Defined results: a null or empty text has fingerprint 0 and links like any
other; a null id is carried along, the component id is the smallest id that
is not null; repeated rows form one component; an empty table gives an
empty result; further columns do not matter to ``components`` and are kept
by ``keep_one``.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import cut, fresh_names, lean, stored

SEED = 42  # fixed value of the contract
CHUNK = 1 << 14  # shingles counted at a time
SEGMENTS, WIDTH = 8, 8


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    found = (text or b"").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not found:
        return 0
    joined = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(found))
    starts, ends = starts[: len(found) - k + 1].tolist(), ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        h = [digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, mark, fp): the fingerprint as a signed long and a hash of the
    text, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "mark", "fp"])

    rows = docs.select(F.col(doc_id).cast("long"), _mark(text), F.col(text))
    return rows.mapInArrow(lean(run), "doc_id long, mark long, fp long")


def _mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ring(start: int, length: int) -> int:
    """Mask of ``length`` segments from ``start`` on, around the ring."""
    return sum(0xFF << (WIDTH * ((start + k) % SEGMENTS)) for k in range(length))


# slot -> (start, mask of the four exact segments)
SLOTS = [(i, _ring(i, 5) & ~_ring((i + out) % SEGMENTS, 1)) for i in range(SEGMENTS) for out in (2, 3, 4)]
# which 3 of the 16 4-bit segments may differ
FINE = [((1 << 64) - 1) ^ sum(0xF << (4 * k) for k in c) for c in combinations(range(16), 3)]


def _keys(fps: DataFrame, masks: list[int]) -> DataFrame:
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    slots = fps.select("fp", F.posexplode(table).alias("slot", "mask"))
    return slots.select("slot", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _link_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """A spanning set of the links within each list of fingerprints."""
    for b in batches:
        out: list[np.ndarray] = []
        for row in b.column(0):
            fps = np.sort(np.array(row.as_py(), np.int64))
            left = np.ones(len(fps), bool)
            todo: list[int] = []
            for first in range(len(fps)):
                if not left[first]:
                    continue
                left[first] = False
                todo.append(first)
                while todo:  # all that a chain of links reaches from here
                    x = fps[todo.pop()]
                    rest = np.flatnonzero(left)
                    near = rest[np.bitwise_count(np.bitwise_xor(fps[rest], x).view(np.uint64)) <= limit]
                    left[near] = False
                    todo.extend(near.tolist())
                    if len(near):
                        out.append(np.stack([np.full(len(near), x), fps[near]]))
        a, z = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], ["a", "b"])


def links(fps: DataFrame, bucket: int = 64, max_distance: int = 3) -> DataFrame:
    """Links (a, b) between different fingerprints of ``fps`` (fp, distinct):
    all of them but in crowded buckets, where a spanning set of each group."""
    if max_distance > 3:
        raise ValueError("the index keys are made for a distance of 3 or less")
    keys = _keys(fps, [m for _, m in SLOTS])
    shared = keys.groupBy("slot", "key").count().filter("count > 1")
    rows = stored(keys.join(shared, ["slot", "key"]), "simhash-buckets")
    few = rows.filter(F.col("count") <= bucket)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.slot") == F.col("b.slot")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    starts = F.array(*[F.array(*[F.lit(_signed(_ring(i, n))) for n in (6, 7)]) for i, _ in SLOTS])
    chain = F.get(starts, F.col("a.slot"))
    near = pairs.filter(
        (F.bit_count(x.bitwiseAND(F.get(chain, F.lit(0)))) <= 6 * 3 // 8)
        & (F.bit_count(x.bitwiseAND(F.get(chain, F.lit(1)))) <= 7 * 3 // 8)
        & (F.bit_count(x) <= max_distance)
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()
    crowded = rows.filter(F.col("count") > bucket).select("fp").distinct()
    fine = _keys(crowded, FINE).groupBy("slot", "key").agg(F.collect_set("fp").alias("fps"))
    fine = fine.filter(F.size("fps") > 1).select("fps")
    dense = fine.mapInArrow(lean(lambda it: _link_groups(it, max_distance)), "a long, b long").distinct()
    return near.unionByName(dense)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node
    it is linked to. Large-star joins every larger neighbour of a node to
    the node's smallest one, small-star every smaller one; the rounds end
    when the edges stay the same."""

    def largest_to_min(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))

    def smallest_to_min(e: DataFrame) -> DataFrame:
        low = e.groupBy("a").agg(F.min("b").alias("low"))
        moved = e.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return moved.unionByName(low.select("a", F.col("low").alias("b")))

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("a", "b"))).first())

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = cut(e)
    before = state(e)
    while before[0]:
        e = cut(smallest_to_min(largest_to_min(e).distinct()).distinct())
        now = state(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def groups(docs: DataFrame, shingle: int = 3, max_distance: int = 3, bucket: int = 64,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, mark, fp, root, component_id), one row per document; ``mark``
    is a hash of the text, ``root`` the smallest fingerprint of the group."""
    fps = stored(fingerprints(docs, shingle, text, doc_id), "simhash")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = stored(components(links(classes.select("fp"), bucket, max_distance)), "simhash-roots")
    of_class = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    linked = of_class.groupBy("root").agg(F.min("first").alias("component_id"))
    named = of_class.select("fp", "root").join(linked, "root")
    return fps.join(named, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3,
             text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each group, with its own columns: that with the
    smallest id (a null id comes last; of one id with several texts, the
    smallest text hash); of repeated rows one stays."""
    found = groups(docs, shingle, max_distance, text=text, doc_id=doc_id)
    kinds = stored(found.groupBy("root", "doc_id", "mark").count(), "simhash-kinds")
    best = kinds.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("best")).select(
        F.col("root").alias("best_root"), "best")
    ranked = kinds.join(best, F.col("root") == F.col("best_root")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark")))
    ranked = stored(ranked.select(F.col("doc_id").alias("of_id"), "mark", "count", "kept"), "simhash-kept")
    (mark,) = fresh_names(docs, "_mark")

    def same(right: DataFrame):
        return df[doc_id].eqNullSafe(right["of_id"]) & (df[mark] == right["mark"])

    df = docs.withColumn(mark, _mark(text))
    gone = ranked.filter("not kept")
    df = df.join(gone, same(gone), "left_anti")
    several = ranked.filter("kept and count > 1")
    if not several.isEmpty():  # only repeated rows are compared in full
        df = df.join(several, same(several), "left_anti").unionByName(
            df.join(several, same(several), "left_semi").dropDuplicates([doc_id, mark]))
    return df.select(*docs.columns)
