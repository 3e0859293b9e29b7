"""The prefix trie against a dictionary of all prefixes."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from finlake.llm import prefix_trie
from finlake.llm.common import ship

ROWS = "conv_id long, turn long, role string, text string, skeleton int, shard string, Path int, turns int"


def brute(rows, stride=20):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % stride, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        n_words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) + (not children[p])
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * n_words
    low = {p: min(c for c, _ in m) for p, m in members.items()}
    return sorted(((low[p], len(p), low[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c, end in sorted(m) if end).encode()).hexdigest()) for p, m in members.items()), key=str)


def run(spark, rows, **how):
    ship(spark)
    df = spark.createDataFrame([(*r, 1, "s", 2, 3) for r in rows], ROWS)
    found = prefix_trie.trie(prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.turns(df))), **how)
    return sorted(map(tuple, found.collect()), key=str)


def conversations(seed, n, turns=4, texts=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b c", "d", None, "", "e  f\tg"][:texts + 2]))
            for c in range(n) for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("shards", [1, 3, 17])
def test_equals_all_prefixes(spark, shards):
    rows = conversations(shards, 150)
    assert run(spark, rows, shards=shards) == brute(rows)


def test_a_very_common_conversation(spark):
    hot = [(c, t, "user", f"word {t}") for c in range(0, 3000) for t in range(3)]
    rows = hot + [(c, t, "user", "other") for c in range(3000, 3100) for t in range(5)]
    assert run(spark, rows, shards=8) == brute(rows)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 5)  # splitters are cut short
    rows = [(c, t, "user", f"w{t % 7} {c % 3 if t > 300 else ''}") for c in range(12) for t in range(250 + 20 * (c % 4))]
    assert run(spark, rows, shards=6) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, None, "user", ""), (1, 1, "user", "x y"), (1, 1, "user", "x y"), (1, 1, "a", "bc"),
            (1, 1, "ab", "c"), (-3, 0, "user", "x"), (7, None, None, None), (40, 5, "user", "z " * 50_000), (41, 5, "user", "z " * 50_000)]
    assert run(spark, rows, shards=3) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_ids_in_pieces(spark):
    rows = [(c, 0, "user", "x") for c in range(300)]
    assert run(spark, rows, shards=4, ids=7) == brute(rows)
