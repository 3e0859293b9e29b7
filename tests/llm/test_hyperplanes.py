"""Random-hyperplane near-duplicates against all pairs."""
import math

import numpy as np
import pytest

from finlake.llm import hyperplanes
from finlake.llm.common import ship

ROWS = "vec_id long, embedding array<float>, label int, V int, node string, links int, key int"


def rows_of(vectors):
    return [(k, v, 1, 2, "x", 3, 4) for k, v in vectors]


def brute(vectors, limit=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(vectors)
    near = [[] for _ in range(n)]
    units = [None if not usable(v) else np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for _, v in vectors]
    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= limit:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((vectors[k][0] for k in seen if vectors[k][0] is not None), default=None)
        out.append((vectors[i][0], len(near[i]), low, vectors[i][0] == low))
    return sorted(out, key=str)


def clusters(seed, groups, size, spread, dim=24):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        out += [(centre + spread * rng.standard_normal(dim)).astype(np.float32).tolist() for _ in range(int(rng.integers(1, size)))]
    return [(k, v) for k, v in enumerate(out)]


@pytest.mark.parametrize("block", [8, 512])
def test_equals_all_pairs(spark, block):
    ship(spark)
    vectors = clusters(3, 25, 30, 0.15)  # cosines around 0.98, groups of up to 29
    vectors += [(1000 + k, vectors[0][1]) for k in range(40)]  # exact copies
    df = spark.createDataFrame(rows_of(vectors), ROWS).repartition(5)
    got = hyperplanes.near_duplicates(df, miss=1e-6, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(vectors)


def test_a_chain_is_one_component(spark):
    ship(spark)
    step = math.acos(0.93)
    vectors = [(50 - k, [math.cos(k * step), math.sin(k * step)]) for k in range(7)]
    df = spark.createDataFrame([(k, v) for k, v in vectors], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, hyperplanes.near_duplicates(df, miss=1e-6).collect()), key=str)
    assert got == brute(vectors)
    assert {r[2] for r in got} == {44} and max(r[1] for r in got) == 2


def test_odd_rows(spark):
    ship(spark)
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, -3.0]
    vectors = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [1.0, None, 1.0]), (6, [1.0, None, 1.0]),
               (7, one), (7, one), (8, [2.0, 4.0, -6.0]), (None, one), (9, one + [0.0]), (10, [1e-30, 2e-30, -3e-30]),
               (11, [-1.0, -2.0, 3.0]), (12, [0.0, 1.0, 0.0]), (13, [-0.0, 1.0, 0.0]), (None, [0.0, 0.0, 1.0]), (14, [3e38, 1.0, 1.0])]
    got = hyperplanes.near_duplicates(spark.createDataFrame(rows_of(vectors), ROWS), miss=1e-6).collect()
    assert sorted(map(tuple, got), key=str) == brute(vectors)
    whole = spark.createDataFrame([(1, [1, 2]), (2, [2, 4])], "vec_id int, embedding array<int>")
    assert sorted(tuple(r) for r in hyperplanes.near_duplicates(whole, miss=1e-6).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_empty_table(spark):
    ship(spark)
    assert hyperplanes.near_duplicates(spark.createDataFrame([], ROWS)).collect() == []


def test_tables_hold_the_promised_recall():
    """Pairs at the limit itself: missed in about ``miss`` of the cases."""
    rng = np.random.default_rng(1)
    bits, limit = 12, 0.9
    a = rng.standard_normal((4000, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.standard_normal((4000, 32))
    b -= (a * b).sum(1)[:, None] * a
    b = limit * a + math.sqrt(1 - limit ** 2) * b / np.linalg.norm(b, axis=1)[:, None]
    tables = hyperplanes.tables_for(bits, limit, 0.01)
    normals = hyperplanes.planes(32, bits, tables)
    found = (hyperplanes.keys_of(a, normals, bits) == hyperplanes.keys_of(b, normals, bits)).any(axis=1)
    assert 0.98 < found.mean() < 1
    alone = np.concatenate([hyperplanes.keys_of(a[k:k + 1], normals, bits) for k in range(50)])
    assert (alone == hyperplanes.keys_of(a[:50], normals, bits)).all()  # the same in every batch
