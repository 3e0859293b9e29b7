"""Phrase collocations by Toivonen's sampling.

Texts are cut into pieces and words; a phrase is up to ``MOST`` words of a
piece, counted per language. A phrase is proposed if it is frequent in a
sample of the documents; the negative border is what is not proposed but
whose beginning and end (each a word shorter) are. One pass over all
documents counts the proposals and their border exactly. If a phrase of the
border turns out frequent, the sample has failed there: it joins the
proposals, and a further pass counts the border that it opens. The passes
end when no border phrase is frequent; then every frequent phrase has been
counted, as all parts of it are frequent and so, step by step, proposed. The
sample is mined by the same passes, starting from nothing.

Proposals are sent to the tasks as a Bloom filter of ``bits`` bits, a fixed
size (deflated on its way, so one with few bits is small). Its false positives only make the border larger: what is counted is
decided by the phrase alone, so every count is exact, and every frequent
phrase is counted at every size of the filter.

Proposals, and border phrases of ``MOST`` words, are counted by their text.
The border of fewer words, by far its largest part, is counted by 44-bit hash:
a sum that is too small proves each phrase of that hash infrequent; one that
is large enough makes them proposals, which the next pass counts by text.
Within a batch words are numbered by an exact dictionary, phrases by pairs of
such numbers.

Both are summed within a task as far as ``HELD`` of them, then dealt by part,
of which there are ``PARTS``. A hash's part is its upper bits, and a row of
the shuffle holds all the lower ones of a part, four bytes each; phrases are
dealt by their letters, and a row holds all phrases of a part and language,
a line each. A part is summed in one piece.

Defined results: a null language is ``und`` (as if it were written so), a
null or empty text has no words; repeated rows count as often as they
occur; a document is cut nowhere but at its own marks, however long; an
empty table gives no phrase; further columns do not matter.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import lean, stored

MOST = 4  # words in a phrase
BYTES = 1 << 20  # of text counted at a time, one document at least
PROBES = 3
LOW = 32  # bits of a hash within its part
PARTS = 1 << 12
HELD = 1 << 19  # hashes, or phrases by text, that a task holds before it sends them

# Fixed values of the contract: separators of words and of pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# what is shuffled: the counts of a part's hashes (``lows``) or of a language's phrases in it (``phrases``, as lines)
SENT = "part int, lows binary, lang string, phrases string, counts binary"
SENT_ARROW = pa.schema([("part", pa.int32()), ("lows", pa.binary()), ("lang", pa.string()), ("phrases", pa.string()), ("counts", pa.binary())])
PASS = "hash long, lang string, phrase string, count long"
PASS_ARROW = pa.schema([("hash", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("count", pa.int64())])
TEXT_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("count", pa.int64())])


class Filter:
    """A Bloom filter of hashes with a fixed number of bits."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.words = np.zeros(max(1, bits // 64), np.uint64)

    def __getstate__(self) -> tuple[np.uint64, bytes]:
        return self.shift, zlib.compress(self.words.tobytes(), 1)

    def __setstate__(self, state: tuple[np.uint64, bytes]) -> None:
        self.shift, self.words = state[0], np.frombuffer(zlib.decompress(state[1]), np.uint64)

    # odd multipliers, one a probe
    MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for m in self.MULTIPLY[:PROBES]:
            bit = (h * m) >> self.shift
            found &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bit = (h[:, None] * self.MULTIPLY[None, :PROBES]).ravel() >> self.shift
        return (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))

    def with_all(self, phrases: DataFrame) -> "Filter":
        """A new filter that has the ``hash`` of every row as well: the bits
        are gathered by the words of the filter, so at most its own size
        comes to the driver."""

        def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, bit = self.places(b.column(0).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], ["at", "bit"])

        new = Filter.__new__(Filter)
        new.shift, new.words = self.shift, self.words.copy()
        found = phrases.select("hash").mapInArrow(lean(bits), "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
        new.words[found["at"].to_numpy()] |= found["bit"].to_numpy().view(np.uint64)
        return new


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its first word and of the rest: its
    part and the bits within."""
    h = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(32))) & np.uint64((PARTS << LOW) - 1)


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A polynomial of each word's bytes, modulo 2^64."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    start, size = ends[:-1] - ends[0], np.diff(ends)
    power = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    h = np.add.reduceat((data + np.uint64(1)) * power[np.arange(len(data)) - np.repeat(start, size)], start)
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)


def _ends(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts, with the number of the piece each is in
    (no two texts share a piece)."""
    ends = _ends(texts)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    kind = KIND[raw]
    inside = kind == 0
    marks = kind == 2
    first = (ends - ends[0])[:-1]
    first = first[first < len(raw)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first] = inside[first]
    marks[first] = True
    at = np.flatnonzero(begins)
    edges = np.zeros(len(at) + 1, np.int64)
    if len(at):  # where a word's letters begin among all letters
        rank = np.cumsum(inside, dtype=np.int64 if len(raw) >> 31 else np.int32)
        edges[:-1], edges[-1] = rank[at] - 1, rank[-1]
    piece = np.cumsum(marks, dtype=np.int32)[at]
    letters = LOWER[raw[inside]]
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(letters)]), piece


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key, a place of each number)."""
    code = pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    place = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    place[code[::-1]] = np.arange(len(code))[::-1]
    return code, place


def _summed(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes in ascending order, with the sums of their counts."""
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(count[order], first) if len(h) else count


def _starts(of: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)


def _cells(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The bytes of the values from each place up to the next."""
    ends = np.append(first, len(values)).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _summed(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes in ascending order, with the sums of their counts."""
    order = np.argsort(h)
    h = h[order]
    first = _starts(h)
    return h[first], np.add.reduceat(count[order], first) if len(h) else count


def _packed(h: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """A row for each part of the border."""
    h, count = _summed(h, count)
    part = (h >> np.uint64(LOW)).astype(np.int32)
    first = _starts(part)
    none = pa.nulls(len(first), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first]), _cells(h.astype("<u4"), first), none, none, _cells(count.astype("<i8"), first)], schema=SENT_ARROW)


def _lines(rows: pa.Table) -> pa.RecordBatch:
    """A row for each part and language of phrases by text."""
    part = np.concatenate([_parts(b.column(1)) for b in rows.to_batches(max_chunksize=1 << 14)])
    rows = rows.combine_chunks()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    key = part * len(langs.dictionary) + langs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(key)
    first = _starts(key[order])
    one = order[first]
    phrase = rows["phrase"].combine_chunks().take(pa.array(order))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), phrase)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[one].astype(np.int32)), pa.nulls(len(first), pa.binary()), langs.take(pa.array(one)).cast(pa.string()),
         pc.binary_join(lists, "\n"), _cells(rows["count"].to_numpy()[order].astype("<i8"), first)], schema=SENT_ARROW)


def _parts(phrase: pa.Array) -> np.ndarray:
    """The part of each phrase; an empty one is told apart by its line end."""
    lines = pc.binary_join_element_wise(phrase.cast(pa.large_binary()), pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    return (_word_hashes(lines) >> np.uint64(LOW)).astype(np.int64) % PARTS


def _by_text(lang: str, phrase: pa.Array, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(phrase):
        yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(phrase)), phrase.cast(pa.string()), pa.array(count, pa.int64())], schema=TEXT_ARROW)


def _added(rows: pa.Table) -> pa.Table:
    return rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("count", "sum")]).rename_columns(TEXT_ARROW.names)


class _Held:
    """What a task has counted: sent when it is too much to hold, and at the end."""

    def __init__(self) -> None:
        self.hashes: list[tuple[np.ndarray, np.ndarray]] = []
        self.texts: list[pa.RecordBatch] = []
        self.n_hashes = self.n_texts = 0

    def border(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.n_hashes and (last or self.n_hashes >= HELD):
            yield _packed(*(np.concatenate(x) for x in zip(*self.hashes)))
            self.hashes, self.n_hashes = [], 0

    def phrases(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.n_texts and (last or self.n_texts >= HELD):
            added = _added(pa.Table.from_batches(self.texts, TEXT_ARROW))
            self.texts, self.n_texts = [], 0
            if last or len(added) >= HELD // 2:
                yield _lines(added)
            else:
                self.texts, self.n_texts = added.to_batches(), len(added)

    def add(self, counted: Iterator[pa.RecordBatch | tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for x in counted:
            if isinstance(x, tuple):
                self.hashes.append(x)
                self.n_hashes += len(x[0])
                yield from self.border()
            else:
                self.texts.append(x)
                self.n_texts += len(x)
                yield from self.phrases()


def _count(lang: str, texts: pa.Array, now: Filter, before: Filter | None, spell: bool) -> Iterator[pa.RecordBatch | tuple[np.ndarray, np.ndarray]]:
    """Counts of the proposals (rows by text) and the border (hashes and
    counts, but for phrases of ``MOST`` words) under ``now``, in texts of one
    language, without those counted under ``before``. Without ``spell``, the
    border of up to ``MOST`` - 1 words alone."""
    words, piece = split(texts)
    if not len(words):
        return
    coded = words.dictionary_encode()
    spelt, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    seed = np.array([xxhash.xxh64_intdigest(lang.encode())], np.uint64)
    plain = _mix(_word_hashes(spelt), seed)
    each = np.bincount(word, minlength=len(spelt))
    has = now.has(plain)
    had = np.zeros(len(spelt), bool) if before is None else before.has(plain)
    if before is None:
        yield plain[~has], each[~has]
        if spell:
            yield from _by_text(lang, pa.array([""]), np.array([len(words)]))
    if spell:
        new = np.flatnonzero(has & ~had)
        yield from _by_text(lang, spelt.take(pa.array(new)), each[new])
    # at a word: whether the phrase of n words that starts there is proposed (and was), its hash and number
    known, was, h, code = has[word], had[word], plain[word], word.astype(np.int64)
    for n in range(2, MOST + spell):
        border = known[:-1] & known[1:]
        if n == 2:
            border &= piece[:-1] == piece[1:]
        at = np.flatnonzero(border)
        if not len(at):
            return
        hashes = _mix(plain[word[at]], h[at + 1])
        has = now.has(hashes)
        old = np.zeros(len(at), bool) if before is None else was[at] & was[at + 1]
        had = old & before.has(hashes) if before is not None else old
        if n < MOST:
            border = hashes[~has & ~old]
            yield border, np.ones(len(border), np.int64)
        if spell:
            text = has & ~had if n < MOST else ~old
            number = np.flatnonzero(has | text)
            found, first = _numbered(code[at[number]] * len(spelt) + word[at[number] + n - 1])
            count = np.bincount(found[text[number]], minlength=len(first))
            some = count > 0
            pick = number[first[some]]
            phrase = pc.binary_join_element_wise(*[spelt.take(pa.array(word[at[pick] + k])) for k in range(n)], pa.scalar(b" ", spelt.type))
            yield from _by_text(lang, phrase, count[some])
            code = np.zeros(len(word), np.int64)
            code[at[number]] = found
        known, was, h = np.zeros(len(word), bool), np.zeros(len(word), bool), np.zeros(len(word), np.uint64)
        known[at], was[at], h[at] = has, had, hashes


def _pass(docs: DataFrame, now: Broadcast, before: Broadcast | None, spell: bool, min_count: int, size: int) -> DataFrame:
    """(hash, lang, phrase, count) of what occurs ``min_count`` times, the
    border by hash, all else by text; and the words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for b in batches:
            langs = b.column(0).cast(pa.string()).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                texts = b.column(1).cast(pa.binary()).filter(pc.equal(langs.indices, k))
                ends, at = _ends(texts), 0
                while at < len(texts):
                    to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
                    yield from held.add(_count(lang, texts.slice(at, to - at), now.value, before and before.value, spell))
                    at = to
        yield from held.border(last=True)
        yield from held.phrases(last=True)

    def add(part: pa.Table) -> pa.Table:
        def all_of(rows: pa.Table, column: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(rows[column].to_pylist()), kind)

        border, texts = part.filter(pc.is_valid(part["lows"])), part.filter(pc.is_null(part["lows"]))
        lows, counts = _summed(all_of(border, "lows", "<u4"), all_of(border, "counts", "<i8"))
        many = counts >= min_count
        hashes = (np.uint64(part["part"][0].as_py()) << np.uint64(LOW)) | lows[many].astype(np.uint64)
        none = pa.nulls(len(hashes), pa.string())
        out = pa.table([pa.array(hashes.view(np.int64)), none, none, pa.array(counts[many], pa.int64())], schema=PASS_ARROW)
        lines = pc.split_pattern(texts["phrases"].combine_chunks(), "\n")
        lang = texts["lang"].combine_chunks().take(pc.list_parent_indices(lines))
        added = _added(pa.table([lang, lines.flatten(), pa.array(all_of(texts, "counts", "<i8"))], schema=TEXT_ARROW))
        added = added.filter(pc.or_(pc.greater_equal(added["count"], min_count), pc.equal(added["phrase"], "")))
        return pa.concat_tables([out, pa.table([pa.nulls(len(added), pa.int64()), *added.columns], schema=PASS_ARROW)])

    return docs.mapInArrow(lean(run), SENT).groupBy("part").applyInArrow(add, PASS)


def proposals(docs: DataFrame, min_count: int, bits: int, size: int = BYTES) -> Filter:
    """The phrases of up to ``MOST`` - 1 words that occur ``min_count`` times
    in ``docs`` (lang, text), as a filter."""
    send = docs.sparkSession.sparkContext.broadcast
    now, sent_before, sent = Filter(bits), None, None
    for _ in range(MOST - 1):
        sent_before, sent = sent, send(now)
        # stored, as in closed(): a stage with two Python steps has two workers for each of its tasks
        now = now.with_all(stored(_pass(docs, sent, sent_before, False, min_count, size), "phrase-proposals"))
    return now


def closed(docs: DataFrame, min_count: int, proposed: Filter, size: int = BYTES) -> tuple[DataFrame, int]:
    """(lang, phrase, count) of all phrases of up to ``MOST`` words with
    ``min_count`` occurrences in ``docs`` (lang, text), and of each
    language's words under an empty phrase; and the number of passes."""
    send = docs.sparkSession.sparkContext.broadcast
    found, now, sent_before, sent = [], proposed, None, None
    while True:
        sent_before, sent = sent, send(now)
        found.append(stored(_pass(docs, sent, sent_before, True, min_count, size), "phrases"))
        failed = found[-1].filter(F.col("hash").isNotNull())
        if failed.isEmpty():
            break
        now = now.with_all(failed)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.filter(F.col("phrase").isNotNull()).select("lang", "phrase", "count"), len(found)


def frequent(docs: DataFrame, min_count: int = 30, sample: int = 8, bits: int = 1 << 26,
             text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(lang, phrase, n, count) of every phrase of up to ``MOST`` words that
    occurs ``min_count`` times in its language; n = 0 holds the language's
    words. One document of ``sample``, by the hash of its id and text,
    proposes, at one occurrence more than the proportion of the bar: a false
    proposal opens a border that is counted in vain, one left out joins the
    second pass, which there is in any case."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    drawn = stored(rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(sample)) == 0).select("lang", "text"), "phrase-sample")
    proposed = proposals(drawn, -(-min_count // sample) + 1, bits)
    found = closed(rows.select("lang", "text"), min_count, proposed)[0]
    return found.withColumn("n", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))))


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, inside_percent: int = 80,
                 sample: int = 8, bits: int = 1 << 26, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The ``top`` phrases of each language (see the module): lang, rank,
    phrase, a, l, r, n, score."""
    found = stored(frequent(docs, min_count, sample, bits, text, lang, doc_id), "phrases-all")
    f = found.filter("n > 0").select("lang", "phrase", F.col("count").alias("f"))
    a = found.filter("n > 1").select("lang", "phrase", "n", F.col("count").alias("a"))
    cuts = a.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "n", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - n)").alias("right"))
    left = f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    cuts = cuts.withColumn("score", F.call_function(
        "div", F.lit(2_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(20,0)"),
        F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")))
    best = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a longer phrase around this one holds one that is one word longer, at least as frequent
    parts = a.filter("n > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', n - 1)"), F.expr("substring_index(phrase, ' ', 1 - n)"))).alias("phrase"))
    around = parts.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    best = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (_whole(F.col("around")) * 100 < _whole(F.col("a")) * inside_percent))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = found.filter("n = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").cast("long").alias("score"))
