"""Mixing and nearest neighbours."""

import collections
import math

import numpy as np

from conftest_llm import ODD, blank_words
from starloom.llm.mixing import mix, mixture
from starloom.llm.neighbours import nearest


def targets_expected(sizes, weights=(5, 2, 1), most=3):
    """By the rule's words: share out, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, set(names)
    while left:
        budget = sum(sizes.values()) - sum(full.values())
        total = sum(weight[s] for s in left)
        over = [s for s in left if budget * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            return full | {s: budget * weight[s] / total for s in left}
        for s in over:
            full[s] = most * sizes[s]
            left.remove(s)
    return full


def test_mix(documents):
    rows = [(i, "w " * (1 + i * 7 % 23), None if i % 11 == 0 else f"s{i % 9 if i % 3 else 0}") for i in range(2000)]
    got = mix(documents(rows)).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert r.taken == r.copies * r.size and r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    expected = targets_expected(sizes)
    for source in sizes:
        assert math.isclose(target[source], expected[source], rel_tol=1e-9)
        assert abs(taken[source] - target[source]) <= 0.02 * target[source] + 23
    assert sum(taken.values()) <= sum(sizes.values())
    again = mix(documents(rows[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_of_odd_documents(odd, documents):
    got = mix(odd).collect()
    sizes = collections.Counter((r.doc_id, r.size) for r in got)
    assert sizes == collections.Counter((d, len(blank_words(t))) for d, t in ODD)
    drawn = mixture(odd)
    assert drawn.columns == [c for c in odd.columns if c != "copies"] + ["copies", "finish"]
    assert drawn.count() == sum(r.copies > 0 for r in got)
    assert mix(documents([])).count() == mixture(documents([])).count() == 0
    assert [r.taken for r in mix(documents([(1, ""), (2, None)])).collect()] == [0, 0]


def nearest_expected(rows, every, k):
    good = set()
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.add((i, tuple(v)))
    by_length = collections.defaultdict(list)
    for i, v in sorted(good):
        by_length[len(v)].append((i, v))
    best = collections.defaultdict(dict)
    for same in by_length.values():
        matrix = np.array([v for _, v in same], dtype=float)
        for q, v in same:
            if q % every == 0:
                gap = matrix - np.array(v)
                for (i, _), score in zip(same, np.sqrt((gap * gap).sum(axis=1)).tolist()):
                    if i != q:
                        best[q][i] = min(best[q].get(i, math.inf), score)
    return {
        q: [(i, s) for s, i in sorted((s, i) for i, s in found.items())[:k]] for q, found in best.items()
    }


def by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, code string, norm double"
    )


def test_nearest(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 48))
    rows = [(i, (centres[i % 20] + 0.5 * rng.standard_normal(48)).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[0][1]) for i in range(300)]  # ties
    expected = nearest_expected(rows, 50, 10)
    got = by_query(nearest(vectors(spark, rows), every=50, block=25))
    assert got.keys() == expected.keys()
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert found >= 0.99 * sum(map(len, expected.values()))


def test_nearest_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [0.5, 0.0]),
            (9, []), (10, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [2.0, 2.0, 3.0]), (20, [5.0, 1.0]), (30, [4.0])]
    expected = nearest_expected(rows, 10, 10)
    assert by_query(nearest(vectors(spark, rows), every=10)) == expected
    # Many vectors of one id near a query leave room for the others.
    rng = np.random.default_rng(4)
    rows = [(1, (np.ones(16) + 0.01 * rng.standard_normal(16)).tolist()) for _ in range(40)]
    rows += [(i, rng.standard_normal(16).tolist()) for i in (0, 0, 100, *range(2, 30))]
    rows += [(0, [1.0] * 16)]
    got, expected = by_query(nearest(vectors(spark, rows), block=1)), nearest_expected(rows, 100, 10)
    assert {q: [i for i, _ in found] for q, found in got.items()} == {
        q: [i for i, _ in found] for q, found in expected.items()
    }
    assert nearest(vectors(spark, [])).count() == 0
    assert nearest(vectors(spark, [(0, [1.0])])).count() == 0
