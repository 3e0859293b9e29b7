"""Toxicity severity by cumulative-link ordinal regression.

P(grade > k | x) = sigmoid(w.x - theta_k): one weight per term shared by all
grades, ordered thresholds theta_0 < theta_1 < ... The severity is the
expected grade, the sum of those probabilities. Terms are the letter runs of
a text, lower-cased, each counted once, so a long text is judged by what
occurs in it and not by its length.

Training takes a documented, bounded sample: the ``max_rows`` labelled rows
with the smallest hash of the id. Of the terms in it the ``n_terms`` with the
largest chi-square against grade 0 are kept, and the weights are fitted with
an L1 penalty. What training reads does not grow beyond the sample's texts.
The model, n_terms weights and a threshold per grade, is what tasks get.

Defined results: a null or empty text has no term and the severity of the
thresholds alone; null grades do not train; without two different grades
nothing can be learned and every severity is 0; repeated rows count as
often as they occur; an empty table gives an empty result; further columns
are carried along, those named like a result column are replaced.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import fresh_names, stored

_letters = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]


def terms(text: str | None) -> set[str]:
    return set(_letters.findall(text.lower())) if text else set()


def _choose_terms(sample: DataFrame, n_terms: int, min_docs: int) -> list[str]:
    n_rows, n_bad = sample.agg(F.count("*"), F.sum((F.col("grade") > 0).cast("long"))).first()
    if not n_bad or n_bad == n_rows:
        return []
    counts = sample.select(F.explode("terms").alias("term"), (F.col("grade") > 0).cast("long").alias("bad")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum("bad").alias("bad")).filter(F.col("n") >= min_docs)
    expected = F.col("n") * (n_bad / n_rows)
    gap = F.col("bad") - expected
    chi = gap * gap / expected + gap * gap / (F.col("n") - expected)
    return [r["term"] for r in counts.orderBy(F.desc(chi), "term").limit(n_terms).select("term").collect()]


def _fit(hits: list[np.ndarray], grades: np.ndarray, n_terms: int, n_grades: int, l1: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient descent with momentum on the mean log-loss."""
    n = len(grades)
    rows = np.repeat(np.arange(n), [len(h) for h in hits])
    cols = np.concatenate(hits) if n else np.empty(0, np.int64)
    share = np.array([(grades > k).mean() for k in range(n_grades - 1)])
    theta = np.log((1 - share) / share)
    w = np.zeros(n_terms)
    back = w.copy()
    df = np.bincount(cols, minlength=n_terms)
    step = 2.0 / np.maximum(df / n, 5.0 / n) / max(1.0, np.mean([len(h) for h in hits]) ** 0.5)
    for i in range(rounds):
        look = w + (i / (i + 3)) * (w - back)
        score = np.bincount(rows, look[cols], minlength=n)
        p = 1 / (1 + np.exp(np.clip(theta - score[:, None], -30, 30)))
        # the probability of a grade is a difference of neighbours
        full = np.hstack([np.ones((n, 1)), p, np.zeros((n, 1))])
        at, after = (np.arange(n), grades), (np.arange(n), grades + 1)
        q = np.maximum(full[at] - full[after], 1e-9)
        slope = p * (1 - p)
        padded = np.hstack([np.zeros((n, 1)), slope, np.zeros((n, 1))])
        up, down = padded[at], padded[after]
        g_score = -(up - down) / q
        grad = np.bincount(cols, g_score[rows], minlength=n_terms) / n
        g_theta = np.array([((grades == k + 1) * (up / q) - (grades == k) * (down / q)).mean() for k in range(n_grades - 1)])
        back, w = w, look - step * 0.25 * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * 0.25 * l1, 0)
        theta = np.maximum.accumulate(theta - 1.0 * g_theta)
    return w, theta


def train(docs: DataFrame, grade: str = "grade", n_terms: int = 2000, min_docs: int = 5, max_rows: int = 20_000,
          l1: float = 2e-4, rounds: int = 300, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fit on the rows of ``docs`` whose ``grade`` (0, 1, ...) is not null."""
    # the sample by a hash of the id, in 0 .. 2^32: its bar follows from a count that reads no text, and
    # the filter on it reaches the documents before any join
    labelled = docs.filter(F.col(grade).isNotNull())
    n_rows = labelled.count()
    bar = (1 << 32) if n_rows <= max_rows else math.ceil((1 << 32) * min(1.0, 1.1 * max_rows / n_rows))
    key = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 32))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(terms(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], ["key", "grade", "terms"])

    drawn = labelled.filter(key < bar).select(key.alias("key"), F.col(grade).cast("int").alias("grade"), F.col(text).alias("text"))
    drawn = drawn.mapInArrow(split, "key long, grade int, terms array<string>")
    sample = stored(drawn.orderBy("key", "grade", "terms").limit(max_rows), "severity-sample")
    names = _choose_terms(sample, n_terms, min_docs)
    if not names:
        return Model({}, ())
    place = {t: i for i, t in enumerate(names)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(place[t] for t in x if t in place) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int32())), b.column(0)], ["grade", "hits", "key"])

    hits = sample.mapInArrow(find, "grade int, hits array<int>, key long")
    data = hits.orderBy("key", "grade", "hits").select("grade", "hits").collect()  # bounded: max_rows times n_terms
    grades = np.array([r["grade"] for r in data])
    n_grades = int(grades.max()) + 1
    if n_grades < 2 or len(set(grades.tolist())) < n_grades:
        levels = sorted(set(grades.tolist()))  # grades that occur, as consecutive ones
        grades = np.searchsorted(levels, grades)
        n_grades = len(levels)
        if n_grades < 2:
            return Model({}, ())
    w, theta = _fit([np.array(r["hits"], np.int64) for r in data], grades, len(names), n_grades, l1, rounds)
    return Model({t: float(x) for t, x in zip(names, w) if x}, tuple(map(float, theta)))


def score_text(text: str | None, model: Model) -> tuple[float, float]:
    """Expected grade and the probability of a grade above 0."""
    if not model.thresholds:
        return 0.0, 0.0
    s = sum(model.weights.get(t, 0.0) for t in sorted(terms(text) & model.weights.keys()))
    p = [float(1 / (1 + np.exp(min(30.0, max(-30.0, t - s))))) for t in model.thresholds]
    return sum(p), p[0]


def score(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents with severity (expected grade), p_toxic and toxic
    (p_toxic of ``least`` or more)."""
    docs = docs.drop("severity", "p_toxic", "toxic")

    @F.pandas_udf("severity double, p_toxic double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([score_text(t, model) for t in texts], columns=["severity", "p_toxic"])

    (name,) = fresh_names(docs, "_judged")
    df = docs.withColumn(name, judge(F.col(text)))
    return df.select(*docs.columns, f"{name}.severity", f"{name}.p_toxic", (F.col(f"{name}.p_toxic") >= least).alias("toxic"))
