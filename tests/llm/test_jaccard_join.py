"""The Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa

from conftest_llm import ODD
from starloom.llm import jaccard_join as J
from starloom.llm.jaccard_join import jaccard_components


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    sets = [shingles(text) for _, text in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(documents, rows, **more):
    return sorted(map(tuple, jaccard_components(documents(rows), **more).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed):
    """Copies with more and fewer edits, boilerplate in most texts, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    boiler = [word() for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 20, 60, 150]))]
        for _ in range(rng.choice([1, 2, 14])):
            words = edited(rng, base, rng.choice([0, 1, 1, 2, 3]))
            if rng.random() < 0.6:
                words = words + boiler
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(25)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components(documents):
    rows = corpus(1)
    assert run(documents, rows) == expected(rows)
    assert run(documents, rows, counters=8) == expected(rows)  # hardly any frequent shingles


def test_template_group_that_no_centre_joins(documents, monkeypatch):
    """Texts of one template, most pairs below the threshold, some above: blocks find them."""
    monkeypatch.setattr(J, "MEMBERS", 16)
    monkeypatch.setattr(J, "SHINGLES", 1 << 11)
    rng = random.Random(2)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(0, 90, 3):
        one = edited(rng, base, 5)
        rows += [(i, " ".join(one)), (i + 1, " ".join(edited(rng, one, 1)))]
        rows.append((i + 2, " ".join(edited(rng, one, 2) + [f"more{k}" for k in range(rng.randrange(25))])))
    want = expected(rows)
    assert 10 < len({component for _, _, component in want}) < 90
    assert run(documents, rows, counters=4) == want


def test_odd_documents(documents):
    rows = [r for r in ODD if len(r[1] or "") < 300_000]
    rows += [(20, "\x85 \xa0 é"), (21, "\x1c a"), (22, "ÀB c"), (23, "Àb C"), (None, "ÀB c"), (24, "kK"), (25, "kk")]
    assert run(documents, rows) == expected(rows)
    assert run(documents, []) == []
    assert run(documents, [(1, None), (2, " ")]) == [(1, 0, 1), (2, 0, 2)]


def test_one_very_long_text_twice(documents):
    words = [f"word{i % 977}x{i // 977}" for i in range(60_000)]
    other = words[:59_000] + [f"y{i}" for i in range(900)]
    rows = [(4, " ".join(words)), (3, " ".join(other)), (9, " ".join(words[:40_000]))]
    assert run(documents, rows) == [(3, 59_896, 3), (4, 59_996, 3), (9, 39_996, 9)]


def test_prefix_bounds():
    """Common shingles are among the keys of both sets, whatever order the hashes give."""
    rng = random.Random(3)
    for _ in range(2000):
        n = rng.randrange(1, 60)
        common = rng.randrange(J.needed(n, 80), n + 1)
        m = rng.randrange(common, max(common, common * 100 // 80 + common // 4) + 1)
        if 100 * common < 80 * (n + m - common):
            continue
        a = list(range(common)) + [1000 + i for i in range(n - common)]
        b = list(range(common)) + [2000 + i for i in range(m - common)]
        order = {x: rng.random() for x in a + b}
        second = {x: rng.random() for x in a + b}
        keys = []
        for side in (a, b):
            sent, kept = J.key_counts(len(side), 80)
            first = sorted(side, key=order.get)[:sent]
            keys.append(set(sorted(first, key=second.get)[:kept]))
        assert keys[0] & keys[1]
        counts = [J.filter_counts(len(side), 80) for side in (a, b)]
        first = [set(sorted(side, key=order.get)[: c[0]]) for side, c in zip((a, b), counts)]
        assert len(first[0] & first[1]) >= min(counts[0][1], counts[1][1])


def test_shared_rows_over_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(40), rng.randrange(5)) for _ in range(150))
    of = {}
    for token, node in rows:
        of.setdefault(token, set()).add(node)
    want = sorted((t, n) for t, ns in of.items() if len(ns) > 1 for n in ns)
    for size in (1, 2, 3, 7, 150):
        batches = [
            pa.RecordBatch.from_pydict({"token": [t for t, _ in rows[i : i + size]], "node": [n for _, n in rows[i : i + size]]})
            for i in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in J._shared(iter(batches)) for r in b.to_pylist()]
        assert got == want


def test_counters_miss_nothing_frequent():
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.integers(0, 1 << 60, 20_000), np.repeat(np.arange(5), 3_000)]).astype(np.uint64)
    rng.shuffle(values)
    counters = J.Frequent(64)
    for part in np.array_split(values, 97):
        counters.add(part)
    counters.settle()
    assert len(counters.values) <= 64
    found = dict(zip(counters.values.tolist(), counters.counts.tolist()))
    for value in range(5):
        assert 3_000 - len(values) / 64 <= found[value] <= 3_000


def test_bitmaps_rule_out_no_linked_pair():
    rng = np.random.default_rng(6)
    for n in (1, 40, 300, 2_000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, n // 20, n // 5, n // 2):
            other = np.concatenate([base[changed:], rng.integers(0, 1 << 63, 2 * changed, dtype=np.uint64)])
            x, y = J.folded([J.parity_bits(base), J.parity_bits(other)])
            differ = int(np.bitwise_count(x ^ y).sum())
            assert differ <= len(np.setxor1d(base, other))
