"""WARC archives with a merged capture index.

``write`` turns pages into WARC/1.1 records (``response``, or ``revisit`` where
an equal payload is stored already) and writes them with Spark's text writer,
a record a row, so archives can lie in any store Spark knows: gzip files of
at most ``records_per_file`` records, each a locally sorted run by URL key
and timestamp. ``scan`` reads the archives back, parses every record by its
Content-Length, recomputes the digests and gives an index row per record.
``merge_index`` merges the runs into one globally ordered capture history:
the key space (URL key, timestamp, record) is ranged over the tasks, so a
URL with a third of all captures is split by time, and each task merges the
runs' slices of its range with a loser tree.

Duplicate payloads are found by digest with map-side maxima; only digests
that occur more than once are joined back.

Defined results: a null html is an empty payload; a null url is stored as
``urn:none`` and sorts by that key; a null page id is stored as an empty
field and comes back null, and is response only if no equal payload has an
id; rows that share the largest page id are all response; an empty table
gives no archive and an empty index; further columns are not written.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.common import ascii_lower, stored

END = "\r\n"
INDEX = ("url_key string, captured long, page_id long, run string, offset long, record_type string, url string, "
         "payload_bytes long, payload_digest string, refers_to long")
_INDEX = pa.schema([
    ("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("run", pa.string()), ("offset", pa.int64()),
    ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query."""
    parts = F.regexp_extract(url, "(?s)^[^:/?#]*://([^/?#]*)(.*)$", 1)
    rest = F.regexp_extract(url, "(?s)^[^:/?#]*://([^/?#]*)(.*)$", 2)
    key = F.concat(F.array_join(F.reverse(F.split(ascii_lower(parts), "\\.")), ","), F.lit(")"), rest)
    return F.when(F.contains(url, F.lit("://")), key).otherwise(url)


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(url_key, captured, page_id, record): the text of each record."""
    one_line = lambda c: F.regexp_replace(c, "[\\r\\n]", "%0A")
    url = F.coalesce(one_line(F.col("url")), F.lit("urn:none"))
    df = pages.select("page_id", "captured", url.alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    df = df.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html")})
    copies = df.filter(F.col("n") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first_id"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    copies = stored(copies, "warc-copies")
    copies = copies.withColumnRenamed("digest", "copied")
    df = df.join(copies, (df["digest"] == copies["copied"]) & (df["n"] >= min_bytes), "left")
    again = F.col("copied").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n"), F.lit(END + END))
    block = F.when(again, F.lit("")).otherwise(F.concat(http, F.col("html")))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    uuid = lambda c: F.concat(F.lit("<urn:page:"), number(c), F.lit(">"))
    seconds = F.col("captured")
    head = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit(f"{END}WARC-Record-ID: "), uuid("page_id"),
        F.lit(f"{END}WARC-Date: "), F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{END}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{END}X-URL-Key: "), url_key(F.col("url")),
        F.lit(f"{END}X-Captured: "), seconds.cast("string"),
        F.lit(f"{END}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"{END}X-Payload-Length: "), F.col("n").cast("string"),
        F.when(again, F.concat(
            F.lit(f"{END}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{END}WARC-Refers-To: "),
            uuid("first_id"))).otherwise(""),
        F.lit(f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(END + END))
    return df.select(url_key(F.col("url")).alias("url_key"), "captured", "page_id", F.concat(head, block).alias("record"))


def write(pages: DataFrame, path: str, min_bytes: int = 1000, records_per_file: int = 5000) -> None:
    """Write ``pages`` (page_id, url, html, captured: seconds since 1970) as
    gzip archives under ``path``. Payloads of ``min_bytes`` or more are stored
    once, by the record with the largest page id."""
    runs = _records(pages, min_bytes).sortWithinPartitions("url_key", "captured", "page_id")
    (runs.select("record").write.option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n\r\n")


def _parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, block) of each record of a gzip archive, unpacked a
    little at a time."""
    unzip = zlib.decompressobj(wbits=31)
    held, start, at = b"", 0, 0
    pos = 0
    while True:
        m = _LENGTH.search(held, pos)
        need = m.end() + int(m[1]) + 4 if m else None
        if need is None or need > len(held):
            if at >= len(data):
                if held[pos:]:
                    raise ValueError(f"truncated record at {start + pos}")
                return
            held, start, pos = held[pos:], start + pos, 0
            more = [held]
            size, goal = len(held), max(1 << 20, (need or 0) - 0)
            while at < len(data) and size < goal + (1 << 20):
                more.append(unzip.decompress(data[at:at + (1 << 16)]))
                size, at = size + len(more[-1]), at + (1 << 16)
            held = b"".join(more)
            continue
        lines = held[pos:m.end() - 4].decode("utf-8").split(END)
        if lines[0] != "WARC/1.1" or held[need - 4:need] != b"\r\n\r\n":
            raise ValueError(f"no record at {start + pos}")
        yield start + pos, dict(x.split(": ", 1) for x in lines[1:]), held[m.end():need - 4]
        pos = need


def _number(value: str) -> int | None:
    digits = value.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of all archives under ``path``, in each run's order;
    length and digest of a response are those of the payload read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                name, rows = b.column(0)[k].as_py().rsplit("/", 1)[-1], []
                for offset, head, block in _parse(b.column(1)[k].as_py()):
                    size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        if (size, digest) != (len(payload), hashlib.sha1(payload).hexdigest()):
                            raise ValueError(f"damaged payload at {offset} of {name}")
                    rows.append({
                        "url_key": head["X-URL-Key"], "captured": int(head["X-Captured"]), "page_id": _number(head["WARC-Record-ID"]),
                        "run": name, "offset": offset, "record_type": head["WARC-Type"], "url": head["WARC-Target-URI"],
                        "payload_bytes": size, "payload_digest": digest,
                        "refers_to": _number(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(run, INDEX)


class LoserTree:
    """k-way merge of sorted lists: each inner node holds the loser of its
    match, the root's winner is the smallest head, and replacing it replays
    one path of log2(k) matches."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads: list[tuple | None] = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # first of its match to arrive
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def merge_index(runs: DataFrame) -> DataFrame:
    """The index rows in global order: by partition, and within it by URL
    key, timestamp and page id."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=_INDEX)
        if not table.num_rows:
            return
        keys = list(zip(table["url_key"].to_pylist(), table["captured"].to_pylist(),
                        ((x is not None, x or 0) for x in table["page_id"].to_pylist()),
                        table["offset"].to_pylist(), range(table.num_rows)))
        slices: dict[str, list[tuple]] = {}
        for name, key in zip(table["run"].to_pylist(), keys):
            slices.setdefault(name, []).append(key)
        for rows in slices.values():  # a run's rows may arrive as several blocks
            if any(x > y for x, y in zip(rows, rows[1:])):
                rows.sort()
        order = pa.array([key[-1] for key in LoserTree([slices[name] for name in sorted(slices)])], pa.int64())
        yield from table.take(order).combine_chunks().to_batches(max_chunksize=10_000)

    ranged = runs.repartitionByRange("url_key", "captured", "page_id", "run", "offset")
    return ranged.mapInArrow(merge, INDEX)
