"""Substring, line and near-duplicate removal against brute force."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql.functions import pandas_udf

from conftest_llm import ODD, blank_words, plain_words
from starloom.llm import lines as L
from starloom.llm import tokens as T
from starloom.llm.components import components
from starloom.llm.lines import dedup_lines, drop_emptied, drop_repeated_lines
from starloom.llm.near_duplicates import (
    drop_near_duplicates,
    likely_pairs,
    near_duplicates,
    parity_bitmap,
)
from starloom.llm.substrings import remove_repeated_passages


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def passages_expected(rows, window=50):
    first = {}
    for doc_id, text in rows:
        words = blank_words(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = blank_words(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), sha(kept)))
    return out


def some_texts(seed, n=60):
    """Texts with shared passages, copies, light edits and loops."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    passages = [[word() for _ in range(rng.randint(50, 130))] for _ in range(5)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        words = [word() for _ in range(rng.randint(0, 200))]
        if kind < 0.3:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        elif kind < 0.4:
            words = words[:7] * 30
        elif kind < 0.6 and texts:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return texts


def order(rows):
    return sorted(rows, key=str)


def test_passages(documents):
    rows = list(enumerate(some_texts(1)))
    got = remove_repeated_passages(documents(rows), max_cells=1 << 16).collect()
    assert order(tuple(r[:4]) for r in got) == order(passages_expected(rows))
    for r in got:
        assert sha(" ".join(blank_words(r.kept_text))) == r.kept_sha256


def test_passages_of_odd_documents(odd, documents):
    got = remove_repeated_passages(odd, with_text=False).collect()
    assert order(map(tuple, got)) == order(passages_expected(ODD))
    assert remove_repeated_passages(documents([])).count() == 0


def lines_expected(rows, n=3, solid=5):
    import re

    order_of = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    lines = [re.findall(r"[^\n\r]+", text or "") for _, text in rows]
    first, out = {}, {}

    def windows(i):
        for k in range(len(lines[i])):
            size = 1 if len(blank_words(lines[i][k])) >= solid else n
            if k + size <= len(lines[i]):
                yield k, tuple(lines[i][k : k + size])

    for i in order_of:
        for k, window in windows(i):
            first.setdefault(window, (i, k))
    for i in order_of:
        gone = [False] * len(lines[i])
        for k, window in windows(i):
            j, m = first[window]
            if (j, m) == (i, k):
                continue
            low, high = 0, len(window)
            while low > 1 - n and k + low > 0 and m + low > 0 and lines[i][k + low - 1] == lines[j][m + low - 1]:
                low -= 1
            while (
                high < len(window) + n - 1
                and k + high < len(lines[i])
                and m + high < len(lines[j])
                and lines[i][k + high] == lines[j][m + high]
            ):
                high += 1
            gone[k + low : k + high] = [True] * (high - low)
        out[i] = (rows[i][0], len(gone), sum(gone), [x for x, g in zip(lines[i], gone) if not g])
    return [out[i] for i in range(len(rows))]


@pytest.mark.parametrize("min_lines, min_words", [(3, 5), (1, 5), (2, 3)])
def test_lines(documents, min_lines, min_words):
    rng = random.Random(4)
    long_lines = [" ".join(rng.choice("xyz") for _ in range(rng.randint(3, 7))) for _ in range(9)]
    texts = []
    for _ in range(90):
        lines = [
            rng.choice(long_lines) if rng.random() < 0.3 else rng.choice("abcdefgh") * rng.randint(1, 3)
            for _ in range(rng.randint(0, 12))
        ]
        texts.append(rng.choice(["\n", "\r\n", "\n\n"]).join(lines))
    rows = list(enumerate(texts))
    import re

    got = dedup_lines(documents(rows), min_lines, min_words).collect()
    mine = [(r.doc_id, r.n_lines, r.n_removed, re.findall(r"[^\n\r]+", r.text)) for r in got]
    assert order(mine) == order(lines_expected(rows, min_lines, min_words))


def test_only_texts_that_lose_lines_are_handed_to_python(documents, monkeypatch):
    @pandas_udf(L._KEPT)
    def strict(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        if (texts.notna() & starts.isna()).any():
            raise ValueError("a text without runs was handed over")
        out = [(None, 0, 0) if t is None else L.kept_lines(t, s, n) for t, s, n in zip(texts, starts, lengths)]
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_removed"])

    monkeypatch.setattr(L, "_cut", strict, raising=False)
    monkeypatch.setattr(L, "_apply", strict, raising=False)
    line = "one line of five words"
    rows = [(1, f"{line}\nx"), (2, f"\r\ny\r\n{line}\u2028z\x85\n"), (3, f"y\n{line}"), (4, None), (5, ""), (6, "\n\r")]
    got = dedup_lines(documents(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan  # texts are not sorted to meet their runs
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got.collect()}
    assert found == {
        1: (rows[0][1], 2, 0), 2: (rows[1][1], 2, 0), 3: ("y", 2, 1), 4: (None, 0, 0), 5: ("", 0, 0), 6: ("\n\r", 0, 0),
    }


def test_single_lines_and_ends_of_runs(documents):
    licence = "this line stands in every file of the place"
    rows = [(1, f"head\n{licence}\ntail"), (2, f"other\n{licence}\nrest"), (3, f"head\n{licence}\nmore"), (4, licence)]
    rows += [(5, "a\nb"), (6, "a\nb")]
    got = {r.doc_id: r.text for r in dedup_lines(documents(rows)).collect()}
    # Two short lines are no window; the line before the licence is equal in 1 and 3.
    assert got == {1: rows[0][1], 2: "other\nrest", 3: "more", 4: "", 5: "a\nb", 6: "a\nb"}


def test_every_repeated_window_keeps_its_fingerprint():
    rng = random.Random(11)
    shared = [rng.choice("abc") + str(i) for i in range(3)]
    for _ in range(50):
        found = []
        for _ in range(2):
            around = [[str(rng.random()) for _ in range(rng.randint(0, 4))] for _ in range(2)]
            text = "\n".join([*around[0], *shared, *around[1]])
            (lines,) = T.words(pa.array([text]), L._LINE_TABLE)
            hashes = lines.hashes()
            at, counts, above = L.winnowed(lines, hashes, 3, 5)
            starts = np.repeat(at, counts) - above
            assert sorted(starts) == list(range(len(hashes) - 2)) and len(at) == len(set(at))
            found.append({hashes[p] for p, s in zip(np.repeat(at, counts), starts) if s == len(around[0])})
        assert found[0] == found[1] and len(found[0]) == 1


def test_columns_named_like_the_counts_stay(documents):
    docs = documents([(1, "a b c d e f"), (2, "a b c d e f\nnew"), (3, "a b c d e f")])
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in kept.collect()} == {
        (1, "a b c d e f", "x", "x"), (2, "new", "x", "x")
    }


def test_lines_of_odd_documents(odd, documents):
    got = dedup_lines(odd)
    assert set(odd.columns) == set(got.columns) and got.count() == len(ODD)
    by_id = {r.doc_id: r for r in got.where("doc_id in (1, 2, 9)").collect()}
    assert by_id[1].text is None and by_id[2].text == ""
    assert by_id[9].text == "a" and by_id[9].n_removed == 4_999
    assert dedup_lines(documents([])).count() == 0
    twice = documents([(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "")])
    assert {r.doc_id for r in drop_emptied(dedup_lines(twice)).collect()} == {1, 3}


def classes_expected(rows, threshold=0.8):
    shingles = []
    for _, text in rows:
        words, seen, out = plain_words(text), collections.Counter(), []
        size = min(5, len(words))
        for i in range(len(words) - size + 1) if size else ():
            key = tuple(words[i : i + size])
            out.append((key, seen[key]))
            seen[key] += 1
        shingles.append(out)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if not a or not b:
                continue
            place, ends = {x: k for k, x in enumerate(b)}, []
            for x in a:
                if x in place:
                    at = bisect.bisect_left(ends, place[x])
                    ends[at : at + 1] = [place[x]]
            if len(ends) / (len(a) + len(b) - len(ends)) >= threshold - 1e-12:
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    return sorted(
        (str(d), str(min((x for x in g if x is not None), default=None))) for g in groups.values() for d in g
    )


def test_near_duplicates(documents):
    rows = list(enumerate(some_texts(7, 120)))
    got = near_duplicates(documents(rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == classes_expected(rows)
    kept = drop_near_duplicates(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def template_group(seed, pairs=500, edits=8, apart=6):
    """Texts made from one template, too far from it and from each other, but for pairs."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(300)]

    def edited(words, n, mark):
        places = rng.sample(range(4, len(words) - 4, 6), n)
        return [f"{mark}w{i}" if i in places else w for i, w in enumerate(words)]

    texts = []
    for k in range(pairs):
        one = edited(template, edits, f"a{k}")
        texts += [one, edited(one, apart, f"b{k}")]
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


def test_near_duplicates_in_a_crowded_group(documents):
    rows = template_group(3)
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_bitmaps_rule_out_no_pair_at_the_threshold():
    rng = np.random.default_rng(5)
    some = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for n in (1, 9, 300, 5_000, 30_000):
        shared = some(n)
        sets = [np.concatenate([shared, some(k)]) for k in (0, n // 9, n // 8, n // 4, 3 * n)]
        size = np.array([len(x) for x in sets])
        bits = [parity_bitmap(x) for x in sets]
        true = {
            (i, j) for j in range(5) for i in range(j)
            if n / (size[i] + size[j] - n) >= 0.8
        }
        for block in ([0] * 5, [0, 1, 0, 1, 0]):
            block = np.array(block)
            found = {tuple(sorted(p)) for p in likely_pairs(np.arange(5), block, size, bits, 0.8, False)}
            asked = {(i, j) for i, j in true if not block.any() or block[i] != block[j]}
            assert asked <= found and all(4 not in p for p in found)


def test_near_duplicates_of_odd_documents(odd, documents):
    got = near_duplicates(odd).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == classes_expected(ODD)
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    # One of the long copies and one of the repeated rows go; texts without words stay.
    assert kept.count() == len(ODD) - 2
    assert near_duplicates(documents([])).count() == 0
    assert drop_near_duplicates(documents([])).count() == 0


def test_components(spark):
    chain = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", "901"), ("901", "900"), ("5", "5")]
    got = components(spark.createDataFrame(chain, "a string, b string"))
    groups = collections.Counter(r.component for r in got.collect())
    assert groups == {"000": 41, "900": 2}


def test_near_texts_that_repeat_a_thousand_times(documents, monkeypatch):
    """Rows that repeat an id and a text are one class, compared once."""
    from starloom.llm import near_duplicates as N

    pairs = []
    linked = N._linked

    def counted(rows, texts, threshold):
        pairs.append((rows.count(), texts.count(), texts.select("node").distinct().count()))
        return linked(rows, texts, threshold)

    monkeypatch.setattr(N, "_linked", counted)
    words = [f"w{i}" for i in range(80)]
    near = words[:79] + ["other"]
    rows = [(1, " ".join(words))] * 1000 + [(2, " ".join(near))] * 1000 + [(None, " ".join(near))] * 3
    got = near_duplicates(documents(rows)).collect()
    assert len(got) == 2003 and {r.class_id for r in got} == {1}
    assert pairs[0] == (1, 2, 2)
