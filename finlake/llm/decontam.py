"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping passages of ``window`` words. Passages and
benchmark items are TF-IDF vectors over the items' terms, with document
frequencies counted over all passages. A randomised SVD of the passage
matrix A gives the latent space: every task adds A^T (A Omega) of its
passages, the sums are added up by blocks of rows, and the Nystroem formula
turns them into singular vectors. The items' own rows are stacked under A, so
each item has a direction even if no passage resembles it yet. A passage
whose cosine with an item in that space reaches ``min_cosine`` is a
candidate. Candidates are checked word by word: the longest common
subsequence (LCS) with the text around the passage must cover ``copy`` of
the item, or ``paraphrase`` of it with the answer, its last sentence, found as
well; a document without words enough of any item for that is not searched.

The benchmark is the query set; it is worked off in blocks of ``block`` items,
so what is sent to the tasks is bounded by a block (its terms times ``rank``).
Each block reads all documents three times: frequencies, sketch, search. A
document is searched within its row, whole; nothing is shuffled but
frequencies and sketch rows.

Defined results: null or empty texts match nothing, on either side; items of
fewer than ``MIN_ITEM`` words, or three different ones, are too short to be
told from chance and match nothing; repeated rows and items are judged one by one; an empty table on
either side gives no match; further columns are carried along.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import fresh_names, give_back, lean

MIN_ITEM = 5
ENTRIES = 1024   # of sparse vectors, multiplied at a time: their products stay in the cache
WORDS = 200_000  # looked up at a time
FAN = 16         # groups of tasks whose sketches are added up first
GRAM = 4096      # terms up to which a task sums their products before it multiplies
PAIRS = 1 << 15  # entries paired at a time
HELD = 1 << 20   # products added at a time, in the order of their places
PRODUCTS = 256   # rows of the products multiplied at a time
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_blank = bytes.maketrans(PUNCTUATION.encode(), b" " * len(PUNCTUATION))
HITS = "array<struct<item_id:long,cosine:double,lcs_ratio:double,answer_ratio:double,at:long>>"


@dataclass(frozen=True)
class Search:
    window: int = 64          # words of a passage
    step: int = 16            # words from one passage to the next
    block: int = 256          # items worked off at a time
    rank: int = 288           # of the latent space of a block
    max_share: float = 0.02   # terms in a larger share of passages carry no weight,
    rarest: int = 8           # but for so many of the rarest of each item
    min_cosine: float = 0.25
    copy: float = 0.9
    paraphrase: float = 0.7
    answer: float = 0.6

    def __post_init__(self) -> None:
        if self.window % self.step:
            raise ValueError("window must be a multiple of step")


def text_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "replace").translate(_blank).split() if text else []


def lcs(item: dict[bytes, int], m: int, text: list[bytes]) -> int:
    """Length of the longest common subsequence of an item, given as a bit
    mask of positions per word, and a list of words."""
    full = (1 << m) - 1
    row = full
    for hit in filter(None, map(item.get, text)):
        both = row & hit
        row = ((row + both) | (row - both)) & full
    return m - row.bit_count()


def masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def answer_words(text: str) -> list[bytes]:
    """The last sentence, or the last four words if it has fewer than that."""
    ends = [i for i, c in enumerate(text[:-1]) if c in ".?!\n" and text_words(text[i + 1:])]
    last = text_words(text[ends[-1] + 1:]) if ends else []
    return last if len(last) >= 4 else text_words(text)[-4:]


@dataclass
class Block:
    """A block of the benchmark with its terms and, once learned, weights
    and latent vectors."""

    ids: list[int]
    words: list[list[bytes]]
    answers: list[list[bytes]]
    terms: dict[bytes, int]
    idf: np.ndarray | None = None
    basis: np.ndarray | None = None      # terms x rank
    latent: np.ndarray | None = None     # items x rank, unit rows

    def item_rows(self) -> np.ndarray:
        out = np.zeros((len(self.ids), len(self.terms)))
        for i, ws in enumerate(self.words):
            for w, n in Counter(ws).items():
                out[i, self.terms[w]] = n * self.idf[self.terms[w]]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _block(rows: list) -> Block:
    kept = [(r[0], ws, answer_words(r[1])) for r in rows if r[1] and len(ws := text_words(r[1])) >= MIN_ITEM]
    terms = {w: i for i, w in enumerate(sorted({w for _, ws, _ in kept for w in ws}))}
    return Block([k[0] for k in kept], [k[1] for k in kept], [k[2] for k in kept], terms)


@dataclass
class Found:
    """Where the words of some texts are terms of a block, and the passages
    of these texts. Steps are counted through all the texts."""

    rows: np.ndarray     # texts with words
    first: np.ndarray    # a text: its first step
    count: np.ndarray    # a text: its passages
    term: np.ndarray     # an occurrence
    doc: np.ndarray      # an occurrence: place in ``rows``
    step: np.ndarray     # an occurrence, ascending
    steps: int
    owner: np.ndarray    # a passage: place in ``rows``
    start: np.ndarray    # a passage: first step
    stop: np.ndarray     # a passage: step behind its last
    at: np.ndarray       # a passage: first word

    def only(self, texts: np.ndarray) -> Found:
        """Without the occurrences and passages of the other texts."""
        o, p = texts[self.doc], texts[self.owner]
        return replace(self, term=self.term[o], doc=self.doc[o], step=self.step[o],
                       owner=self.owner[p], start=self.start[p], stop=self.stop[p], at=self.at[p])


def _found(texts: Iterable[str | None], block: Block, s: Search) -> Iterator[Found]:
    """The texts with words, ``WORDS`` words or a text more at a time."""
    rows: list[int] = []
    parts: list[np.ndarray] = []
    held, span = 0, s.window // s.step

    def made() -> Found:
        nonlocal held
        sizes = np.array([len(x) for x in parts])
        steps = -(-sizes // s.step)
        first = np.cumsum(steps) - steps
        count = np.maximum(1, steps - span + 1)
        term = np.concatenate(parts)
        place = np.flatnonzero(term >= 0)
        doc = np.repeat(np.arange(len(sizes)), sizes)[place]
        step = first[doc] + (place - (np.cumsum(sizes) - sizes)[doc]) // s.step
        owner = np.repeat(np.arange(len(sizes)), count)
        local = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = first[owner] + local
        out = Found(np.array(rows), first, count, term[place], doc, step, int(steps.sum()),
                    owner, start, np.minimum(start + span, (first + steps)[owner]), local * s.step)
        rows.clear()
        parts.clear()
        held = 0
        return out

    for row, value in enumerate(texts):
        words = text_words(value)
        if words:
            rows.append(row)
            parts.append(np.fromiter(map(block.terms.get, words, repeat(-1)), np.int32, len(words)))
            held += len(words)
            if held >= WORDS:
                yield made()
    if rows:
        yield made()


def _passages_with(f: Found, n_terms: int, s: Search) -> np.ndarray:
    """In how many passages each term occurs."""
    span = s.window // s.step
    order = np.argsort(f.term.astype(np.int64) * len(f.rows) + f.doc, kind="stable")
    term, doc = f.term[order], f.doc[order]
    step = f.step[order] - f.first[doc]
    low, high = np.maximum(step - span + 1, 0), np.minimum(step, f.count[doc] - 1)
    again = np.flatnonzero((term[1:] == term[:-1]) & (doc[1:] == doc[:-1])) + 1
    low[again] = np.maximum(low[again], high[again - 1] + 1)  # passages that the occurrence before has not counted
    return np.bincount(term, high - low + 1, n_terms).astype(np.int64)


def _frequencies(docs: DataFrame, block: Block, s: Search, text: str) -> tuple[np.ndarray, int]:
    """Over all passages, in how many each term occurs; their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(len(block.terms), np.int64)
        for b in batches:
            for f in _found(b.column(0).to_pylist(), block, s):
                n += len(f.owner)
                seen += _passages_with(f, len(seen), s)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*seen[some], n], pa.int64())], ["term", "n"])

    rows = docs.select(text).mapInArrow(lean(count), "term int, n long").groupBy("term").agg(F.sum("n")).collect()
    df = np.zeros(len(block.terms))
    total = 0
    for term, n in rows:
        if term < 0:
            total = n
        else:
            df[term] = n
    return df, total


@dataclass
class Vectors:
    """Some passages with weighted terms. A passage's vector is the sum of
    its steps' (term counts times idf), so what overlapping passages share
    is multiplied once."""

    owner: np.ndarray    # a passage: row of its text
    at: np.ndarray       # a passage: first word
    square: np.ndarray   # a passage: sum of its words' squared weights
    parts: np.ndarray    # a passage: its steps with entries; the last row for none
    step: np.ndarray     # an entry, from 0, ascending
    terms: np.ndarray    # an entry
    weights: np.ndarray  # an entry

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The vectors as rows, multiplied by a terms x rank matrix."""
        first = np.flatnonzero(np.concatenate([[True], self.step[1:] != self.step[:-1]]))
        sums = np.add.reduceat(self.weights.astype(matrix.dtype)[:, None] * matrix[self.terms], first, axis=0)
        sums = np.concatenate([sums, np.zeros((1, matrix.shape[1]), matrix.dtype)])
        out = sums[self.parts[:, 0]]
        for part in self.parts.T[1:]:
            out += sums[part]
        return out

    def add_transposed(self, rows: np.ndarray, total: np.ndarray) -> None:
        """Adds the transposed vectors times ``rows`` to ``total``."""
        sums = np.zeros((self.step[-1] + 2, rows.shape[1]), rows.dtype)
        for part in self.parts.T:  # no step is the k-th of two passages
            sums[part] += rows
        order = np.argsort(self.terms, kind="stable")
        terms = self.terms[order]
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        total[terms[first]] += np.add.reduceat(self.weights.astype(rows.dtype)[order, None] * sums[self.step[order]], first, axis=0)


def _vectors(f: Found, idf: np.ndarray, s: Search) -> Iterator[Vectors]:
    """The passages that have weighted terms, ``ENTRIES`` entries or a
    passage more at a time."""
    entry = np.flatnonzero(idf[f.term] > 0)
    if not len(entry):
        return
    terms, step = f.term[entry], f.step[entry]
    weights = idf[terms]
    squares = np.concatenate([[0.0], np.cumsum(weights * weights)])
    first = np.searchsorted(step, np.arange(f.steps + 1))
    filled = first[1:] > first[:-1]
    number = np.append(np.where(filled, np.cumsum(filled) - 1, -1), -1)  # of a step among those with entries
    low, high = first[f.start], first[f.stop]
    some = np.flatnonzero(high > low)
    low, high = low[some], high[some]
    p = 0
    while p < len(some):
        q = max(p + 1, int(np.searchsorted(high, low[p] + ENTRIES, "right")))
        e0, e1, now = low[p], high[q - 1], some[p:q]
        mine = number[step[e0:e1]]
        begin, none = mine[0], mine[-1] - mine[0] + 1
        parts = np.stack([np.where(f.start[now] + j < f.stop[now], number[np.minimum(f.start[now] + j, f.steps)], -1)
                          for j in range(s.window // s.step)], axis=1)
        parts = np.where(parts < 0, none, parts - begin)
        yield Vectors(f.rows[f.owner[now]], f.at[now], squares[high[p:q]] - squares[low[p:q]], parts, mine - begin, terms[e0:e1], weights[e0:e1])
        p = q


def _products(f: Found, idf: np.ndarray, s: Search) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Half of A^T A of the passages of ``f``, as unit vectors, in products
    of two entries with their places: the sum with its transpose is the
    whole. Two entries are multiplied once for all passages that share them,
    with the sum of these passages' weights."""
    entry = np.flatnonzero(idf[f.term] > 0)
    if not len(entry):
        return
    terms, step = f.term[entry].astype(np.int64), f.step[entry]
    weights = idf[terms]
    first = np.searchsorted(step, np.arange(f.steps + 1))
    squares = np.concatenate([[0.0], np.cumsum(weights * weights)])
    filled = first[f.stop] > first[f.start]
    start, stop = f.start[filled], f.stop[filled]
    weight = 1.0 / (squares[first[stop]] - squares[first[start]])
    span = s.window // s.step
    for apart in range(span):
        shared = np.zeros(f.steps)  # a step: the weights of the passages with it and the one so far behind it
        for k in range(span - apart):
            both = start + k + apart < stop  # no step is the k-th of two passages
            shared[start[both] + k] += weight[both]
        ahead = np.flatnonzero(shared[step] > 0)
        for at in range(0, len(ahead), PAIRS):
            one = ahead[at:at + PAIRS]
            low = first[step[one] + apart]
            n = first[step[one] + apart + 1] - low
            end = np.cumsum(n)
            other = np.arange(end[-1]) + np.repeat(low - end + n, n)
            value = weights[one] * shared[step[one]] * (1.0 if apart else 0.5)
            yield np.repeat(terms[one] * len(idf), n) + terms[other], np.repeat(value, n) * weights[other]


class Gram:
    """The sum of such products, terms x terms."""

    def __init__(self, terms: int) -> None:
        self.total = np.zeros((terms, terms))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, f: Found, idf: np.ndarray, s: Search) -> None:
        for places, values in _products(f, idf, s):
            self.held.append((places, values))
            self.size += len(places)
            if self.size >= HELD:
                self.settle()

    def settle(self) -> None:
        if self.held:
            places, values = (np.concatenate(x) for x in zip(*self.held))
            order = np.argsort(places)  # memory is met in order
            np.add.at(self.total.reshape(-1), places[order], values[order])
            self.held, self.size = [], 0

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """A^T A times a terms x rank matrix."""
        self.settle()
        out = np.empty_like(matrix)
        for k in range(0, len(matrix), PRODUCTS):
            out[k:k + PRODUCTS] = (self.total[k:k + PRODUCTS] + self.total[:, k:k + PRODUCTS].T).astype(matrix.dtype) @ matrix
        return out


def _sketch(docs: DataFrame, block: Block, omega: np.ndarray, s: Search, text: str) -> np.ndarray:
    """A^T A Omega over all passages, as unit vectors; sums of tasks are
    folded in two levels, so no key is read from very many tasks at once.
    A^T A itself is summed within a task, if the block has few terms."""
    rank, height = omega.shape[1], 64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, single = np.zeros_like(omega), omega.astype(np.float32)
        gram = Gram(len(omega)) if len(omega) <= GRAM else None
        for b in batches:
            for f in _found(b.column(0).to_pylist(), block, s):
                if gram is not None:
                    gram.add(f, block.idf, s)
                    continue
                for v in _vectors(f, block.idf, s):
                    v.add_transposed(v.times(single) / v.square.astype(np.float32)[:, None], total)
        if gram is not None:
            total += gram.times(single)
        group = TaskContext.get().partitionId() % FAN
        for k in range(0, len(total), height):
            part = total[k:k + height]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([group], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["k", "g", "part"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, part in zip(b.column("k").to_pylist(), b.column("part")):
                x = np.frombuffer(part.as_py(), np.float64).reshape(-1, rank)
                sums[k] = sums[k] + x if k in sums else x
        for k, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["k", "part"])

    parts = docs.select(text).mapInArrow(lean(add), "k int, g int, part binary")
    for keys in (("k", "g"), ("k",)):
        parts = parts.repartition(*keys).mapInArrow(lean(fold), "k int, part binary")
    out = np.zeros_like(omega)
    for k, part in parts.collect():  # a block's terms times the rank
        out[k:k + height] = np.frombuffer(part, np.float64).reshape(-1, rank)
    return out


def _learn(docs: DataFrame, block: Block, s: Search, text: str) -> None:
    df, n = _frequencies(docs, block, s, text)
    weighted = df <= s.max_share * n
    for words in block.words:
        own = sorted({block.terms[w] for w in words}, key=lambda t: (df[t], t))
        weighted[own[: s.rarest]] = True
    block.idf = np.where(weighted, np.log((2 + n) / (1 + df)), 0.0)
    rng = np.random.default_rng(11)
    omega = rng.standard_normal((len(block.terms), min(s.rank, len(block.terms))))
    items = block.item_rows()
    weight = 1.0 + n / max(1, len(items)) * 0.01  # an item's row counts as this many passages
    y = _sketch(docs, block, omega, s, text) + weight * (items.T @ (items @ omega))
    shift = np.sqrt(len(y)) * np.finfo(np.float32).eps * max(np.linalg.norm(y), 1e-300)  # products are of single precision
    y = y + shift * omega
    core = omega.T @ y
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > value.max() * 1e-7
    b = y @ (vector[:, good] / np.sqrt(value[good]))
    block.basis = np.linalg.svd(b, full_matrices=False)[0].astype(np.float32)
    latent = items @ block.basis
    block.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _holds(block: Block) -> np.ndarray:
    """How often each item (column) has each term (row)."""
    out = np.zeros((len(block.terms), len(block.ids)), np.int32)
    for i, ws in enumerate(block.words):
        for w, n in Counter(ws).items():
            out[block.terms[w], i] = n
    return out


def _match(texts: list[str | None], block: Block, holds: np.ndarray, item_masks: list, answer_masks: list, s: Search) -> list[list[dict]]:
    best: list[dict[int, dict]] = [{} for _ in texts]
    sizes = np.array([len(ws) for ws in block.words])
    row, words = -1, []
    for f in _found(texts, block, s):
        # the LCS is at most the item's words that the text has
        ends = np.searchsorted(f.doc, np.arange(len(f.rows) + 1))
        hopeful = np.array([holds[np.unique(f.term[i:j])].sum(axis=0) / sizes >= s.paraphrase for i, j in zip(ends, ends[1:])])
        for v in _vectors(f.only(hopeful.any(axis=1)), block.idf, s):
            latent = v.times(block.basis)
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
            cosine = latent @ block.latent.T
            for p, i in zip(*np.nonzero((cosine >= s.min_cosine) & hopeful[np.searchsorted(f.rows, v.owner)])):
                if v.owner[p] != row:
                    row = int(v.owner[p])
                    words = text_words(texts[row])
                m, at = len(block.words[i]), int(v.at[p])
                near = words[max(0, at - m):at + s.window + m]
                ratio = lcs(item_masks[i], m, near) / m
                if ratio < s.paraphrase:
                    continue
                a = len(block.answers[i])
                answer = lcs(answer_masks[i], a, near) / a
                if ratio < s.copy and answer < s.answer:
                    continue
                old = best[row].get(i)
                if old is None or (ratio, float(cosine[p, i])) > (old["lcs_ratio"], old["cosine"]):
                    best[row][i] = {"item_id": block.ids[i], "cosine": float(cosine[p, i]), "lcs_ratio": ratio, "answer_ratio": answer, "at": at}
    return [[found[i] for i in sorted(found)] for found in best]


def search(docs: DataFrame, benchmark: DataFrame, settings: Search | None = None, text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with ``hits``, an array of (item_id, cosine, lcs_ratio,
    answer_ratio, at: first word of the passage), empty if clean."""
    s = settings or Search()
    docs = docs.drop("hits")
    items = benchmark.select(F.col(item_id).cast("long"), F.col(item_text)).orderBy(item_id, item_text)
    empty = F.array().cast(HITS)
    df = docs.withColumn("hits", empty)
    rows: list = []
    (more,) = fresh_names(df, "_more")
    for row in [*items.toLocalIterator(), None]:  # a block of items at a time
        if row is not None:
            rows.append(row)
            if len(rows) < s.block:
                continue
        block, rows = _block(rows), []
        if not block.ids:
            continue
        _learn(docs, block, s, text)
        df = df.withColumn(more, _matcher(block, s)(F.col(text)))
        df = df.withColumn("hits", F.concat("hits", F.coalesce(more, empty))).drop(more)
    return df


def _matcher(block: Block, s: Search):
    @F.pandas_udf(HITS)
    def match(texts: pd.Series) -> pd.Series:
        item_masks, answer_masks = [masks(w) for w in block.words], [masks(w) for w in block.answers]
        found = pd.Series(_match(texts.tolist(), block, _holds(block), item_masks, answer_masks, s), dtype=object)
        give_back()
        return found

    return match.asNondeterministic()  # so that no filter on the hits, written or inferred, runs it again
