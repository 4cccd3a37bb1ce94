"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from starloom.llm import prefix_trie as P
from starloom.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth string, n string"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq in nodes:
        if seq:
            children[seq[:-1]] += 1
    for seq, members in nodes.items():
        size = (len(members) - 1) * len(seq[-1][1].encode()) if seq else 0
        for d in range(len(seq) + 1):
            saved[seq[:d]] += size
            leaves[seq[:d]] += seq not in children
    out = []
    for seq, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(seq))
        out.append(
            (min(members), len(seq), min(nodes[seq[:-1]]) if seq else None, len(members),
             children[seq], leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie(frame, **more).collect()), key=str)


def some_rows(seed, n=80):
    """Few different turns, so that prefixes are shared far beyond the heads."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, 6, 9, 12])):
            role = ("user", "assistant")[turn % 2]
            rows.append((c, turn, role, rng.choice(["yes", "no é", ""]) if rng.random() < 0.9 else f"{c} {turn}"))
    rng.shuffle(rows)
    return rows


def test_trie(spark):
    rows = some_rows(1)
    assert run(spark, rows) == expected(rows)


def test_weak_hashes_are_found_out(spark):
    rows = some_rows(2, 30)
    assert run(spark, rows, primes=(7, 101, P.PRIME)) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "left out"), (0, None, None, None), (0, 0, "", ""), (0, 1, "user", "x"),
        (3, 5, "user", "x" * 300_000), (3, None, "user", "first"), (3, None, "user", "also first"),
        (7, 0, "user", "no base"), (8, 0, None, "no base"), (8, 0, None, "no base"), (8, 1, "a", "b"),
        (-7, 0, "user", "negative"), (-5, 0, "user", "negative"), (-3, 0, "user", "sign"),
        (11, -4, "user", "a"), (11, -4, "user", "a"), (12, 0, "ab", "c"), (12, 1, "a", "bc"),
        (1 << 62, 0, "user", "large id"),
    ]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_a_conversation_over_many_ranges(spark):
    """One conversation holds most of all turns; each of eight ranges has a part of it."""
    rows = [(10, t, "user", f"turn {t}") for t in range(300)]
    rows += [(12, t, "user", f"turn {t}") for t in range(120)] + some_rows(3, 20)
    assert run(spark, rows) == expected(rows)


def test_monoid():
    rng = random.Random(9)
    turns = [P.turn_hash("r", str(rng.random()), 0) for _ in range(9)]

    def of(some):
        total = (0, 0)
        for t in some:
            total = P.joined(total, (1, t))
        return total

    for i in range(10):
        assert P.joined(of(turns[:i]), of(turns[i:])) == of(turns)
        assert P.without_head(of(turns), of(turns[:i])) == of(turns[i:])
    assert P.turn_hash("ab", "c", 0) != P.turn_hash("a", "bc", 0)
