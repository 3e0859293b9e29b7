"""Language identification by rank-order profiles.

A profile ranks the most frequent letter n-grams (1 to 3 letters, words
padded with ``_``) of a language. A document's own ranking is compared to
each: the out-of-place distance adds, for every n-gram of the document's
profile, how far its rank is from the language's, and a full profile length
if the language lacks it. The nearest language wins. Whole texts are counted, as arrays of code points.

Profiles are learned from all rows that the caller passes, by n-gram counts
per language, added up within each task before the shuffle and keyed by
language and n-gram, so no language gathers in one task. A profile is at most
``length`` entries; all profiles are kept, on the driver as arrays of 8 bytes
an entry. Documents are held against ``block`` languages at a time, which
bounds what one function sends to the executors.

Defined results: a null text or one without a letter is ``und`` with score
0, as is every text when nothing was learned; equal distances go to the
language first in code point order; repeated rows are judged one by one; an
empty table gives an empty result; further columns are carried along, those
named like a result column are replaced.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finlake.llm.common import cut, fresh_names

LENGTH = 300
BLOCK = 1000  # languages
CHUNK = 1 << 20  # characters counted at a time
PAD = ord("_")
_letter: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter, made once in a process."""
    if not _letter:
        _letter.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letter[0]


def padded(text: str) -> str:
    return f"_{text.lower()}_"


def grams(text: str, starts: int | None = None) -> np.ndarray:
    """All n-grams of a padded text, of 1 to 3 letters in words padded with
    ``_``, each as its code points packed into one integer, so that they sort
    as text. A gram has a letter in it, and padding at its ends only. With
    ``starts``, those that begin in so many of the first characters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _is_letter()[points]
    points = np.where(letter, points, PAD)
    two = letter[:-1] | letter[1:]
    pairs = (points[:-1] << 42 | points[1:] << 21)
    threes = pairs[:-1] | points[2:]
    return np.concatenate([points[:starts][letter[:starts]] << 42, pairs[:starts][two[:starts]], threes[:starts][letter[1:-1][:starts]]])


def pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text, those that start in one piece of ``CHUNK``
    characters at a time: each is read two characters beyond its end."""
    whole = padded(text)
    for k in range(0, len(whole), CHUNK):
        yield grams(whole[k:k + CHUNK + 2], CHUNK)


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in order, with the sums of their counts."""
    codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def ranking(text: str, length: int) -> np.ndarray:
    """The most frequent n-grams, ties in code point order."""
    parts = [np.unique(g, return_counts=True) for g in pieces(text)]
    codes, counts = parts[0] if len(parts) == 1 else counted(parts)
    return codes[np.argsort(-counts, kind="stable")[:length]]


def learn(docs: DataFrame, length: int = LENGTH, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Profiles (n-grams by rank) by language, from all rows with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size: Counter = Counter()
        sums: dict[str, tuple] = {}

        def add(name: str) -> None:
            new = np.unique(grams(padded(" ".join(held.pop(name)))), return_counts=True)
            sums[name] = counted([sums[name], new]) if name in sums else new
            size[name] = 0

        for b in batches:
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if value:
                    held.setdefault(name, []).append(value)
                    size[name] += len(value)
                    if size[name] >= CHUNK:
                        add(name)
        for name in list(held):
            add(name)
        for name, (codes, counts) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    labelled = docs.filter(F.col(lang).isNotNull()).select(F.col(lang), F.col(text))
    counts = labelled.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= length)
    profiles = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("top"))
    rows = profiles.select("lang", "top.gram").toLocalIterator()
    found = {r["lang"]: np.array(r["gram"], np.int64) for r in rows}
    return {name: found[name] for name in sorted(found)}


class Ranks:
    """Profiles as sorted n-grams with their ranks."""

    def __init__(self, profiles: dict[str, np.ndarray], length: int) -> None:
        self.length, self.tables = length, []
        for name, grams in profiles.items():
            codes = np.array(grams, np.int64)
            order = np.argsort(codes)
            self.tables.append((name, codes[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.tables or not has_letter(text):
            return "und", 0.0
        own = ranking(text, self.length)
        at = np.arange(len(own))
        best, least = "und", None
        for name, codes, ranks in self.tables:
            place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            d = int(np.where(codes[place] == own, np.abs(ranks[place] - at), self.length).sum())
            if least is None or d < least:
                best, least = name, d
        return best, 1.0 - least / (self.length * len(own))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], length: int = LENGTH, text: str = "text", block: int = BLOCK) -> DataFrame:
    """The documents with lang_pred and score (1: the same ranking, 0: no
    n-gram in common). They are held against ``block`` languages at a time;
    the nearest of all blocks stays, of equal ones the first."""
    docs = docs.drop("lang_pred", "score")
    best, new = fresh_names(docs, "_judged", "_nearer")
    names = sorted(profiles)
    df = docs
    for k in range(0, max(1, len(names)), block):
        judge = _judge(Ranks({n: profiles[n] for n in names[k:k + block]}, length))
        if k == 0:
            df = df.withColumn(best, judge(F.col(text)))
        else:  # what the blocks before said is written, so that no task gets two blocks
            df = cut(df).withColumn(new, judge(F.col(text)))
            df = df.withColumn(best, F.when(F.col(f"{new}.score") > F.col(f"{best}.score"), F.col(new)).otherwise(F.col(best))).drop(new)
    return df.select(*docs.columns, f"{best}.lang_pred", f"{best}.score")


def _judge(ranks: Ranks):
    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([ranks.predict(t) for t in texts], columns=["lang_pred", "score"])

    return judge
