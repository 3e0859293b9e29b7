"""Token ids in compressed files with random access.

A token table lies under one folder:

- ``dictionary``: one row, the shared zstandard dictionary, its SHA-256 and
  the bytes per id (2 or 4, little-endian);
- ``blocks``: per row about ``block_bytes`` of documents in order: their
  zstandard frames one after the other (``payload``) and the offset index
  (``doc_ids``, ``offsets``, ``n_tokens``, ``starts`` within the shard),
  with ``first_doc`` and ``last_doc`` and the dictionary's hash;
- ``shards``: per shard its first document and how many ids lie before it.

Each document is one frame, so a single one is read by its block's index
(Parquet statistics skip the other blocks) and one short decompression.
Everything is written and read by Spark's Parquet source, so the folder can
be in any store Spark knows.

The documents are ranged by id once, tokenised after that shuffle in id
order and written by the same tasks; starts are a sum over the shards, one
row each. The dictionary is trained on the ids of ``sample`` documents, those
with the smallest hash of their id and at most ``SAMPLE_BYTES`` each.

Tokenisation is that of the given tokenizer file. A byte-level BPE never
joins bytes across a blank that follows a non-blank, so texts are cut there
and the ids of each word are kept between documents; a text for which that
is not certain (a special token's string, white space in a row) goes through
whole. Some megabytes of text are cut at a time: their different words are
looked up once each, new ones are tokenised as one text, and the ids of the
documents are gathered from those of the words.

Defined results: a null or empty text is a document without ids (but for
the end id); a null id sorts first; rows with one id stand together, by
text hash; an empty table gives empty tables; further columns are not
written.
"""
from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finlake.llm.common import lean

KEPT = 800_000       # words a worker remembers
SLICE = 4 << 20      # characters encoded at a time, one text at least
SAMPLE_BYTES = 8192  # of one document, for the dictionary
MARKS = ".,;:!?#$%&*"
_rare_space = re.compile("[\x00\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_tokenizers: dict[str, "Encoder"] = {}


def regular(text: str) -> bool:
    """Whether every blank and line end stands between two words, at most one
    at a time, and there is no other white space."""
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or _rare_space.search(text))


class Encoder:
    """Ids of whole texts by a byte-level BPE file, with remembered words."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.begins = np.zeros(self.vocabulary, bool)  # tokens that begin with a blank
        self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
        self.line_end = self.tokenizer.token_to_id("\u010a")
        self.marks: dict[str, bytes] = {}   # punctuation behind a word
        self.known: dict[str, bytes] = {}   # a word with the blank before it, a line's first word or a line end -> ids
        self.older: dict[str, bytes] = {}   # what was known before ``known`` was full

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _together(self, words: list[str]) -> list[bytes]:
        """The ids of words that each have a blank before them, as one text:
        a token that begins with a blank begins a word."""
        text = "".join(words)
        if not any(s in text for s in self.special):
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(words):
                data, ends = ids.tobytes(), [*(at * self.dtype.itemsize).tolist(), ids.nbytes]
                return [data[a:b] for a, b in zip(ends, ends[1:])]
        return [self._whole(w) for w in words]

    def _as_lines(self, words: list[str]) -> list[bytes]:
        """The ids of words without blanks, as the lines of one text: a line
        end between words is a token of its own."""
        text = "\n".join(words)
        if len(words) > 1 and not any(s in text for s in self.special):
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            at = np.flatnonzero(ids == self.line_end) if self.line_end is not None else ()
            if len(at) == len(words) - 1:
                data, size = ids.tobytes(), self.dtype.itemsize
                return [data[a:b] for a, b in zip([0, *((at + 1) * size).tolist()], [*(at * size).tolist(), len(data)])]
        return [self._whole(w) for w in words]

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of different words that are not in ``known``; they are from
        then on."""
        known, older = self.known, self.older
        out = list(map(older.get, words))
        firsts: list[int] = []                  # places of words without a blank
        alone: list[int] = []                   # places of other words that are tokenised as they are
        stems: dict[str, bytes | None] = {}
        marked: list[tuple[int, str, str]] = []
        for k, w in enumerate(words):
            if out[k] is not None:
                continue
            if w in ("", " ", "\n"):
                out[k] = self._whole(w)
                continue
            if w[0] != " ":
                firsts.append(k)
                continue
            if w[-1] in MARKS:  # a letter and the punctuation behind it are never one token
                stem = w.rstrip(MARKS)
                if stem[-1].isalpha():
                    if stem not in stems:
                        stems[stem] = known.get(stem) or older.get(stem)
                    marked.append((k, stem, w[len(stem):]))
                    continue
            alone.append(k)
        if firsts:
            for k, x in zip(firsts, self._as_lines([words[k] for k in firsts])):
                out[k] = x
        some = [stem for stem, ids in stems.items() if ids is None]
        if alone or some:
            ids = self._together([words[k] for k in alone] + some)
            for k, x in zip(alone, ids):
                out[k] = x
            stems.update(zip(some, ids[len(alone):]))
        for k, stem, mark in marked:
            if mark not in self.marks:
                self.marks[mark] = self._whole(mark)
            out[k] = stems[stem] + self.marks[mark]
        if len(known) + len(words) + len(some) > KEPT // 2:
            self.known, self.older = {}, known
        self.known.update(zip(words, out))
        self.known.update((stem, stems[stem]) for stem in some)
        return out

    def _regular(self, texts: list[str]) -> list[bytes]:
        """The ids of regular texts. A blank stays with the word behind it."""
        cut = pa.array([t.replace(" ", "\0 ").replace("\n", "\0\n\0") for t in texts], pa.large_string())
        split = pc.split_pattern(cut, "\0")
        words = split.flatten().dictionary_encode()
        names, code = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        found = list(map(self.known.get, names))
        if None in found:
            new = iter(self._learn([w for w, x in zip(names, found) if x is None]))
            found = [next(new) if x is None else x for x in found]
        pool = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        start = np.cumsum(size) - size
        n = size[code]
        end = np.cumsum(n)
        data = pool[np.arange(end[-1]) + np.repeat(start[code] - end + n, n)].tobytes()
        edges = np.concatenate([[0], end])[split.offsets.to_numpy()] * self.dtype.itemsize
        return [data[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]

    def encode_all(self, texts: Sequence[str | None], end: int | None = 0) -> Iterator[bytes]:
        """The ids of each text as little-endian integers, with the end id."""
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        at = 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and (to == at or held + len(texts[to] or "") <= SLICE):
                held += len(texts[to] or "")
                to += 1
            part = texts[at:to]
            plain = [bool(t) and regular(t) and not any(s in t for s in self.special) for t in part]
            some = [t for t, p in zip(part, plain) if p]
            ids = iter(self._regular(some) if some else [])
            for t, p in zip(part, plain):
                yield (next(ids) if p else self._whole(t) if t else b"") + tail
            at = to

    def encode(self, text: str | None, end: int | None = 0) -> bytes:
        return next(self.encode_all([text], end))


def encoder(path: str) -> Encoder:
    if path not in _tokenizers:
        _tokenizers[path] = Encoder(path)
    return _tokenizers[path]


def _train(docs: DataFrame, tokenizer: str, end: int | None, sample: int, size: int, text: str, doc_id: str) -> bytes:
    """A dictionary from a bounded sample (empty if there is too little)."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[:SAMPLE_BYTES] for x in enc.encode_all(b.column(0).to_pylist(), end)], pa.binary())], ["ids"])

    order = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    last = docs.select(order.alias("o")).orderBy("o").limit(sample).agg(F.max("o")).first()[0]  # ids only, no texts
    few = docs.filter(order <= F.lit(last)).select(order.alias("o"), F.substring(text, 1, SAMPLE_BYTES).alias("t"))
    few = few.filter(F.length("t") > 0).orderBy("o", "t").limit(sample).select("t")
    samples = [bytes(r["ids"]) for r in few.mapInArrow(lean(ids), "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, tokenizer: str, end: int | None = 0, sample: int = 1000, dictionary_bytes: int = 65536,
          block_bytes: int = 1 << 20, level: int = 3, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the documents' ids under ``path``, in ascending id order."""
    spark = docs.sparkSession
    raw = _train(docs, tokenizer, end, sample, dictionary_bytes, text, doc_id)
    digest = hashlib.sha256(raw).hexdigest()
    width = encoder(tokenizer).dtype.itemsize
    spark.createDataFrame([(digest, width, bytearray(raw))], "dict_hash string, id_bytes int, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        compress = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdCompressor(level=level)
        shard, number, seen, held = TaskContext.get().partitionId(), 0, 0, 0
        ids: list = []
        lengths: list[int] = []
        counts: list[int] = []
        starts: list[int] = []
        frames: list[bytes] = []

        def block() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64).tolist()
            row = {"shard": shard, "block": number, "first_doc": ids[0], "last_doc": ids[-1], "dict_hash": digest,
                   "doc_ids": list(ids), "offsets": offsets, "n_tokens": list(counts), "starts": list(starts), "payload": b"".join(frames)}
            for x in (ids, lengths, counts, starts, frames):
                x.clear()
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1).to_pylist(), end)):
                frame = compress.compress(data)
                ids.append(name)
                lengths.append(len(frame))
                frames.append(frame)
                counts.append(len(data) // width)
                starts.append(seen)
                seen += counts[-1]
                held += len(frame)
                if held >= block_bytes:
                    yield block()
                    number, held = number + 1, 0
        if ids:
            yield block()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ranged.mapInArrow(lean(blocks), _BLOCKS_SQL).write.option("compression", "uncompressed").parquet(f"{path}/blocks")

    tokens = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x)
    shards = spark.read.schema(_BLOCKS_SQL).parquet(f"{path}/blocks").groupBy("shard").agg(
        F.min("first_doc").alias("first_doc"), F.sum(tokens).alias("n"))
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")  # one row per shard
    shards.select("shard", "first_doc", before.alias("before")).coalesce(1).write.parquet(f"{path}/shards")


_BLOCKS = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("dict_hash", pa.string()),
    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.int64())), ("payload", pa.binary())])
_BLOCKS_SQL = ("shard int, block int, first_doc long, last_doc long, dict_hash string, doc_ids array<long>, "
               "offsets array<long>, n_tokens array<long>, starts array<long>, payload binary")


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of all documents, or of
    those named: then only blocks that can hold them are read, and only
    their frames decompressed."""
    d = spark.read.parquet(f"{path}/dictionary").first()
    digest, raw, dtype = d["dict_hash"], bytes(d["dictionary"]), np.dtype(f"<u{d['id_bytes']}")
    blocks = spark.read.schema(_BLOCKS_SQL).parquet(f"{path}/blocks")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        hit = F.lit(False)
        for x in sorted(wanted):
            hit = hit | ((F.col("first_doc").isNull() | (F.col("first_doc") <= x)) & (F.col("last_doc") >= x))  # null ids come first
        blocks = blocks.filter(hit)
    shards = spark.read.parquet(f"{path}/shards").select("shard", "before")
    blocks = blocks.join(F.broadcast(shards), "shard").select("before", "dict_hash", "doc_ids", "offsets", "n_tokens", "starts", "payload")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
        for b in batches:
            for k in range(b.num_rows):
                before, its, names, offsets, counts, starts, payload = (c[k].as_py() for c in b.columns)
                if its != digest:
                    raise ValueError(f"block of another dictionary: {its}")
                out: list[tuple] = []
                for i, name in enumerate(names):
                    if wanted is not None and name not in wanted:
                        continue
                    ids = np.frombuffer(expand.decompress(payload[offsets[i]:offsets[i + 1]]), dtype)
                    if len(ids) != counts[i]:
                        raise ValueError(f"document {name}: {len(ids)} ids, not {counts[i]}")
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    out.append((name, before + starts[i], counts[i], crc, *([ids.astype(np.int64)] if with_ids else [])))
                cols = list(zip(*out)) or [()] * (4 + with_ids)
                arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.list_(pa.int64())) for c in cols[4:]]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    return blocks.mapInArrow(lean(unpack), schema)
