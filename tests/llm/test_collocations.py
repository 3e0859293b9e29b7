"""Toivonen mining against counting every phrase."""
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finlake.llm import collocations
from finlake.llm.common import ship

ROWS = "doc_id long, text string, lang string, phrase string, N int, count int, rank int"


def phrases(rows):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][" ".join(w[i:i + k])] += 1
    return n, f


def brute(rows, low=30, top=2000):
    n, f = phrases(rows)
    out = []
    for lang, all_ in f.items():
        f_ = {p: c for p, c in all_.items() if c >= low}
        cand = {p: c for p, c in f_.items() if " " in p}
        best = []
        for p, a in cand.items():
            if any(len(q) > len(p) and f" {p} " in f" {q} " and 100 * c >= 80 * a for q, c in cand.items()):
                continue
            w = p.split(" ")
            score, k = min((2_000_000 * a // (f_[" ".join(w[:k])] + f_[" ".join(w[k:])]), k) for k in range(1, len(w)))
            best.append((-score, -a, p.encode(), p, f_[" ".join(w[:k])], f_[" ".join(w[k:])]))
        out += [(lang, r, p, -a, l, r_, n[lang], -s) for r, (s, a, _, p, l, r_) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "p", 1, 2, 3) for r in rows], ROWS)


def some_text(rng, n):
    words = ["New", "York", "city", "hall", "the", "of", "Über", "中文", "a", "b'c"] + [f"w{k}" for k in range(40)]
    out = []
    while len(out) < n:
        out += rng.choice([["New", "York", "city", "hall"], ["of", "the"], ["中文", "Über", "a"]]) if rng.random() < 0.25 else [rng.choice(words)]
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ", ", "\n", "\r\n", "!?", "\t", "  "])
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(k, some_text(rng, rng.randint(0, 120)), rng.choice(["en", "de", None, "und"])) for k in range(300)] + [
        (900, some_text(rng, 20_000), "en"), (901, None, "en"), (902, "", None), (None, "New York " * 50, "xx"), (903, "x" * 200_000, "en"), (903, "x" * 200_000, "en")]


@pytest.mark.parametrize("bits", [64, 1 << 20])  # a filter that is nearly full counts more and returns the same
def test_equals_counting_everything(spark, rows, bits):
    got = collocations.collocations(frame(spark, rows), min_count=12, top=25, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, 25)


def plain(spark, rows):
    return frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def wanted(rows, low):
    n, f = phrases(rows)
    return sorted([(lang, p, c) for lang, of in f.items() for p, c in of.items() if c >= low] + [(lang, "", c) for lang, c in n.items() if c])


@pytest.mark.parametrize("bar", [None, 1, 6, 12, 10_000])
def test_any_proposals_are_mended_by_further_passes(spark, rows, bar):
    df = plain(spark, rows)
    few = df.filter(F.length("text") < 300)
    proposed = collocations.proposals(few, bar, 1 << 20) if bar else collocations.Filter(1 << 20)
    found, passes = collocations.closed(df, 12, proposed)
    assert sorted(map(tuple, found.collect())) == wanted(rows, 12)
    assert passes == 4 if bar in (None, 10_000) else passes <= 4


def test_very_large_products(spark):
    big = 4_000_000_000_000_000_000
    df = spark.createDataFrame([(big, big, big - 1)], "a long, l long, r long").select(F.call_function(
        "div", F.lit(2_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(20,0)"),
        F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")).alias("s"))
    assert df.first().s == 2_000_000 * big // (2 * big - 1)


def test_small_batches_and_repeated_rows(spark, rows):
    twice = rows[:80] + rows[:80]
    got = collocations.collocations(frame(spark, twice), min_count=6)
    assert sorted(map(tuple, got.collect())) == brute(twice, 6)
    found, _ = collocations.closed(plain(spark, twice), 6, collocations.Filter(1 << 20), size=200)
    assert sorted(map(tuple, found.collect())) == wanted(twice, 6)


def test_empty_table(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [(1, None, None), (2, " \t.", "en")])).collect() == []


def test_a_filter_with_few_bits_is_small_on_its_way():
    f = collocations.Filter(1 << 26)
    h = np.arange(1, 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, bit = f.places(h)
    np.bitwise_or.at(f.words, at, bit)
    sent = pickle.dumps(f)
    assert len(sent) < 1 << 17
    got = pickle.loads(sent)
    assert got.has(h).all() and (got.words == f.words).all()


def test_what_is_shuffled_is_a_row_for_each_part():
    rng = np.random.default_rng(5)
    h = rng.integers(0, collocations.PARTS << collocations.LOW, 100_000, dtype=np.uint64)
    border = collocations._packed(np.concatenate([h, h[:10]]), np.arange(100_010))
    assert border.num_rows <= collocations.PARTS
    assert sum(len(x) for x in border["lows"].to_pylist()) == 4 * len(set(h.tolist()))
    assert sum(np.frombuffer(x, "<i8").sum() for x in border["counts"].to_pylist()) == 100_009 * 100_010 // 2
    rows = [(lang, phrase, 1) for lang in ("de", "en") for phrase in ["", "é ü", *(f"w{k} x" for k in range(20_000))]]
    lines = collocations._lines(pa.table(list(map(list, zip(*rows))), schema=collocations.TEXT_ARROW))
    assert lines.num_rows <= 2 * collocations.PARTS
    got = [(r["lang"], p) for r in lines.to_pylist() for p in r["phrases"].split("\n")]
    assert sorted(got) == sorted(r[:2] for r in rows)
    parts = {}
    for r in lines.to_pylist():
        for p in r["phrases"].split("\n"):
            assert parts.setdefault(p, r["part"]) == r["part"]
