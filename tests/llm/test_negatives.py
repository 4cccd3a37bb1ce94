"""Hard negatives against brute force."""

import math
import random

import numpy as np

from starloom.llm import negatives as N
from starloom.llm.negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, key string, block string"


def expected(rows, every=100, positives=5, negatives=10):
    good = {
        (i, label, tuple(v))
        for i, v, label in rows
        if i is not None and v is not None and label is not None
        and all(x is not None and math.isfinite(x) for x in v)
    }
    whole = [(i, label, v, [math.floor(256 * x) for x in v]) for i, label, v in good]
    out = []
    for a in whole:
        if a[0] % every:
            continue
        scored = sorted(
            (max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a[3], b[3])))) * -1, b[0], b[1])
            for b in whole
            if b is not a and len(b[3]) == len(a[3])
        )
        for s, i, label in [x for x in scored if x[2] == a[1]][:positives]:
            inside = [
                (-t, j) for t, j, other in scored
                if other != a[1] and 30 * -s <= 100 * -t <= 90 * -s
            ][:negatives]
            out += [(a[0], i, r, j, -s, t) for r, (t, j) in enumerate(inside, 1)]
    return sorted(out)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives(frame, **more).collect()))


def test_hard_negatives(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        centre = i % 4
        v = [rng.gauss(0.6 if d == centre else 0.0, 0.3) for d in range(6)]
        rows.append((i, v, centre if rng.random() < 0.7 else rng.randrange(4)))
    assert run(spark, rows, every=50) == expected(rows, every=50)


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(4)
    few = [[float(rng.randint(-1, 2)) / 256 for _ in range(3)] for _ in range(6)] + [[0.0, 0.0, 0.0]]
    rows = [(i, rng.choice(few), rng.randrange(2)) for i in range(300)]
    rows += rows[:40]  # repeated rows
    rows += [(0, [1.0, 0.5, 0.25], 1), (0, [1.0, 0.5, 0.25], 0), (7, [0.5, 0.5, 0.5], 1)]  # repeated ids
    rows += [(100, [0.5, 0.25], 1), (501, [0.5, 0.2], 0), (502, [0.5, 0.3], 1), (200, [], 1), (503, [], 0)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (600, None, 1), (601, [1.0, None, 0.0], 1), (602, [1.0, 1.0, 1.0], None)]
    rows += [(603, [math.nan, 0.0, 0.0], 1), (604, [math.inf, 0.0, 0.0], 0), (-100, [0.5, 0.5, 0.5], 0)]
    assert run(spark, rows, every=20) == expected(rows, every=20)


def test_large_components(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(1e6, 1e8) for _ in range(2)], i % 2) for i in range(30)]
    rows += [(100, [1e300, 2.0], 0), (101, [1e300, 1e12], 1), (102, [1e200, 3.0], 0)]
    assert run(spark, rows, every=10) == expected(rows, every=10)


def test_rounds_blocks_and_chunks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0.3, 0.3) for _ in range(4)], rng.randrange(3)) for i in range(500)]
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "ROUND", 1)
    assert run(spark, rows, every=10) == expected(rows, every=10)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []
    assert run(spark, [(3, [1.0], 1), (4, [1.0], 2)]) == []


def test_exact_products():
    rng = np.random.default_rng(1)
    for size in (10, 1 << 20, 1 << 40):
        x, y = (np.floor(rng.uniform(-size, size, (5, 3))) for _ in range(2))
        true = [[int(sum(int(a) * int(b) for a, b in zip(r, s))) for s in y] for r in x]
        true = [[max(N.LEAST, min(N.MOST, v)) for v in r] for r in true]
        assert N.inner_products(x, y).tolist() == true
