"""Documents whose sets of five-word shingles overlap, joined by prefix filters under several
global orders of the shingles.

At Jaccard similarity ``t`` a set of ``n`` shingles shares at least ``ceil(t * n)`` with its
partner, so under any order of all shingles both hold a common one among their first
``n - ceil(t * n) + 1``; among their first ``n - ceil(t * n) + l``, they hold ``l``. A
candidate has to pass this test under every order used here:

0. Shingles by hash, but the most frequent ones of the corpus last. Each document sends its
   first ``n - ceil(t * n) + l`` shingles; those that no other document sends are dropped.
1. Among what was sent, rarest first, by counts over all documents: ``l`` common shingles
   of so many mean one among the rarest but ``l - 1``. Only these stay as join keys, so a
   document that is mostly its own has none.
2. By a second hash: the candidate pairs of step 1 below have to share as many of their
   first shingles as ``filter_counts`` says.

What passes is compared by parity bitmaps, which rule out no linked pair, and then verified
on the whole sets, which only these classes send.

Sets, not documents, are compared: copies are one class. Step 1: in each key one class is the
centre, and every other is a candidate with it: a row for each class, never pairs. A class
is first compared with the centre it shares most keys with, then with those of its centres
that are in other components still. Step 2: where a
key then still holds several components, its classes are compared in full, those of alike
size against each other, in blocks of bounded size; a block hands on links that join
components, never all its pairs. Keys with equal classes are done once. No key is capped.

The most frequent shingles are found by counters that miss none with more than
``1 / COUNTERS`` of all occurrences, so what is broadcast has a fixed size, and any other
shingle's rows are a small share of the whole by proof. The work of the last step grows with
the square of the classes in a key that its centre did not join.

Words are runs of other characters than blanks, A-Z folded to a-z; a document of one to four
words has one shingle, of all its words. Shingles are 64-bit hashes of their words.

Defined cases: a document without words, or with a null text, has no shingles and is linked
with nothing: its component is its own id. A null id never names a component, unless all
ids in it are null. Rows that repeat, with one id or several, are documents of their own.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import tokens as T
from starloom.llm.components import components
from starloom.session import materialise

SHINGLE = 5
COUNTERS = 1 << 16  # frequent shingles known to every task
MEMBERS, SHINGLES = 256, 1 << 19  # most classes, and most shingles, in a block
COLUMNS = 1 << 13  # shingles counted at a time in a block
_SECOND = np.uint64(0x9E3779B97F4A7C15)


def needed(n, percent: int):
    """Shingles that a set of ``n`` shares at least with one it is linked to."""
    return (percent * n + 99) // 100


def spare(n, percent: int):
    """``l``: a quarter of the shingles that need not be shared, 1 at least; it never falls
    as ``n`` grows."""
    return min(needed(n, percent), (n - needed(n, percent)) // 4 + 1)


def key_counts(n, percent: int) -> tuple[int, int]:
    """Shingles that a set of ``n`` sends under order 0, and those of them, rarest first, that
    can be keys under order 1. A partner has ``needed(n)`` shingles or more, and so sends
    ``spare(needed(n))`` common ones at least."""
    need = needed(n, percent)
    sent = n - need + spare(n, percent)
    return sent, sent - spare(need, percent) + 1


def filter_counts(n, percent: int) -> tuple[int, int]:
    """First shingles of a set of ``n`` under order 2, and how many of them it shares with
    any partner that is not smaller; the second number never falls as ``n`` grows, so a
    pair shares what the smaller set needs."""
    need = needed(n, percent)
    common = min(need, (n - need) // 2 + 1)
    return n - need + common, common


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number and sorted distinct shingles of each text that has words."""
    for piece in T.words(column, T.BLANK_TABLE, T.PLAIN_FOLD):
        hashes = piece.hashes()
        for i, (a, b) in enumerate(zip(piece.bounds.tolist(), piece.bounds[1:].tolist())):
            if b > a:
                yield piece.first + i, np.unique(T.sequences(hashes[a:b], min(SHINGLE, b - a)))


def _name(shingles: np.ndarray, seed: int) -> int:
    """A hash of a set."""
    ends = np.zeros(1, dtype=np.int64), np.full(1, len(shingles))
    return int(T.spans_hash(T.mixed(shingles + np.uint64(seed)), *ends).view(np.int64)[0])


class Frequent:
    """Counters of the most frequent values: each is too low by at most ``seen / size``."""

    def __init__(self, size: int):
        self.size = size
        self.values = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.held += len(values)
        if self.held > 8 * self.size:
            self.settle()

    def settle(self) -> None:
        new, counts = np.unique(np.concatenate([*self.waiting, self.values[:0]]), return_counts=True)
        self.waiting, self.held = [], 0
        values, place = np.unique(np.concatenate([self.values, new]), return_inverse=True)
        total = np.zeros(len(values), dtype=np.int64)
        np.add.at(total, place, np.concatenate([self.counts, counts]))
        if len(values) > self.size:
            total -= np.partition(total, len(total) - self.size - 1)[len(total) - self.size - 1]
        self.values, self.counts = values[total > 0], total[total > 0]


_SETS = "doc_id long, text_key long, node long, other long, n long, token long, seen long"


def _named_sets(seed: int, counters: int):
    """A row for each document with words, and the frequent shingles of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(counters)

        def rows(ids, keys, names, sizes, tokens, seen) -> pa.RecordBatch:
            count = max(len(ids), len(tokens))
            empty = pa.nulls(count, pa.int64())
            columns = [ids, keys, [x for x, _ in names], [y for _, y in names], sizes, tokens, seen]
            columns = [pa.array(c, pa.int64()) if len(c) else empty for c in columns]
            return pa.RecordBatch.from_arrays(
                columns, ["doc_id", "text_key", "node", "other", "n", "token", "seen"]
            )

        for batch in batches:
            at, names, sizes = [], [], []
            for i, shingles in _sets(batch.column("text")):
                at.append(i)
                names.append((_name(shingles, 2 * seed), _name(shingles, 2 * seed + 1)))
                sizes.append(len(shingles))
                frequent.add(shingles)
            if at:
                some = pa.array(at)
                yield rows(
                    batch.column("doc_id").take(some), batch.column("text_key").take(some),
                    names, sizes, [], [],
                )
        frequent.settle()
        if len(frequent.values):
            yield rows([], [], [], [], frequent.values.view(np.int64), frequent.counts)

    return run


class Orders:
    """The global orders: by hash, frequent shingles last, the rarer of them first."""

    def __init__(self, frequent: np.ndarray):
        self.sorted = np.sort(frequent)
        self.rank = np.argsort(frequent, kind="stable")

    def split(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The others, and the frequent ones by their rank."""
        if not len(self.sorted):
            return shingles, shingles[:0]
        at = np.minimum(np.searchsorted(self.sorted, shingles), len(self.sorted) - 1)
        known = self.sorted[at] == shingles
        often = shingles[known]
        return shingles[~known], often[np.argsort(self.rank[at[known]])]

    def first(self, shingles: np.ndarray, count: int, order: np.uint64) -> np.ndarray:
        """The first shingles under a further order."""
        rare, often = self.split(shingles)
        rare = rare[np.argsort(T.mixed(rare + order))]
        return np.concatenate([rare, often])[:count]


def _sent(frequent, percent: int, seed: int):
    """The first shingles of each document; ``often`` marks frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(frequent.value)
        for batch in batches:
            tokens, often, nodes = [], [], []
            for _, shingles in _sets(batch.column("text")):
                rare, frequent_ones = orders.split(shingles)
                first = np.concatenate([rare, frequent_ones])[: key_counts(len(shingles), percent)[0]]
                tokens.append(first)
                often.append(np.arange(len(first)) >= len(rare))
                nodes.append(np.full(len(first), _name(shingles, 2 * seed), dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)),
                     pa.array(np.concatenate(often))],
                    ["token", "node", "often"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle and node, those of shingles that several nodes hold, each
    once. Of the group that is open at the end of a batch, at most one row is held back."""
    token, node, waits = None, None, False
    for batch in batches:
        tokens, nodes = (batch.column(c).to_numpy() for c in ("token", "node"))
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
        if len(new) and token is not None:
            new[0] = tokens[0] != token or nodes[0] != node
        tokens, nodes = tokens[new], nodes[new]
        if not len(tokens):
            continue
        goes_on = token is not None and tokens[0] == token and not waits
        if waits:
            tokens, nodes = np.append(token, tokens), np.append(node, nodes)
        opens = np.ones(len(tokens), dtype=bool)
        opens[1:] = tokens[1:] != tokens[:-1]
        group = np.cumsum(opens) - 1
        several = np.bincount(group) > 1
        several[0] |= goes_on
        token, node, waits = tokens[-1], nodes[-1], not several[-1]
        kept = several[group]
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[kept]), pa.array(nodes[kept])], ["token", "node"]
        )


def parity_bits(shingles: np.ndarray) -> bytes:
    """A bit for each rest of the hashes by a power of two, at least as many as shingles:
    whether it occurs an odd number of times. Bits of two sets differ in no more places than
    the sets do in shingles."""
    width = max(256, 1 << (len(shingles) - 1).bit_length())
    places = (shingles & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all folded to the width of the shortest."""
    width = min(map(len, bits))
    rows = np.zeros((len(bits), width // 8), dtype=np.uint64)
    for i, raw in enumerate(bits):
        for part in np.frombuffer(raw, dtype=np.uint64).reshape(-1, width // 8):
            rows[i] ^= part
    return rows


def _bits_fit(percent: int):
    """Pairs that their bitmaps don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            pairs = (folded([x, y]) for x, y in bits)
            differ = np.array([int(np.bitwise_count(x ^ y).sum()) for x, y in pairs], dtype=np.int64)
            fit = pa.array(differ * (100 + percent) <= total * (100 - percent))
            yield batch.select(["a", "b"]).filter(fit)

    return run


def _filters(frequent, percent: int):
    """The first shingles under order 2, as 32-bit values (some may fall together), and the
    bitmap of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(frequent.value)
        for batch in batches:
            at, sizes, firsts, bits = [], [], [], []
            for i, shingles in _sets(batch.column("text")):
                bits.append(parity_bits(shingles))
                first = orders.first(shingles, filter_counts(len(shingles), percent)[0], _SECOND)
                at.append(i)
                sizes.append(len(shingles))
                firsts.append(np.unique(first.astype(np.uint32)).view(np.int32))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(at)), pa.array(sizes, pa.int64()),
                     pa.array(firsts, pa.list_(pa.int32())), pa.array(bits, pa.binary())],
                    ["node", "n", "second", "bits"],
                )

    return run


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, sets = [], []
        for i, shingles in _sets(batch.column("text")):
            at.append(i)
            sets.append(shingles.view(np.int64))
        if at:
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(at)), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array(sets, pa.list_(pa.int64()))],
                ["node", "n", "shingles"],
            )


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every set on the left with every one on the right."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    x, y = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in (left, right))
    both = np.intersect1d(x, y)
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    places = []
    for side in (x, y):
        at = np.minimum(np.searchsorted(both, side), max(len(both) - 1, 0))
        places.append((at, both[at] == side if len(both) else np.zeros(len(side), dtype=bool)))
    for low in range(0, len(both), COLUMNS):
        width = min(COLUMNS, len(both) - low)
        tables = []
        for count, row, (at, known) in zip(out.shape, rows, places):
            table = np.zeros((count, width), dtype=np.float32)
            here = known & (at >= low) & (at < low + width)
            table[row[here], at[here] - low] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int64)
    return out


def _arrays(table: pa.Table, name: str, rows: np.ndarray) -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[at[i] : at[i + 1]] for i in rows]


def _near(table: pa.Table, percent: int):
    """The two sides of a meeting, and which pairs of alike size are in different
    components."""
    component, block, n = (table.column(c).to_numpy() for c in ("component", "of_block", "n"))
    sides = [np.flatnonzero(block == b) for b in np.unique(block)]
    first, second = sides[0], sides[-1]
    x, y = n[first][:, None], n[second]
    near = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
    return first, second, near & (component[first][:, None] != component[second])


_MEMBERS = ("token", "s", "i", "t", "j", "node", "component", "n", "of_block")


def _possible_in_block(percent: int):
    """The classes of a meeting that have a partner by the bitmaps."""

    def run(table: pa.Table) -> pa.Table:
        first, second, near = _near(table, percent)
        n, rows = table.column("n").to_numpy(), folded(table.column("bits").to_pylist())
        for i, a in enumerate(first.tolist()):
            some = np.flatnonzero(near[i])
            if len(some):
                b = second[some]
                differ = np.bitwise_count(rows[b] ^ rows[a]).sum(axis=1, dtype=np.int64)
                near[i, some] = differ * (100 + percent) <= (n[a] + n[b]) * (100 - percent)
        kept = np.union1d(first[near.any(axis=1)], second[near.any(axis=0)])
        return table.select(list(_MEMBERS)).take(pa.array(kept, pa.int64()))

    return run


def _links_in_block(percent: int):
    """Links between different components in two blocks of a key, or within one."""

    def run(table: pa.Table) -> pa.Table:
        node, component, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        first, second, near = _near(table, percent)
        found: list[tuple[int, int]] = []
        if near.any():
            shared = shared_counts(*(_arrays(table, "shingles", side) for side in (first, second)))
            total = n[first][:, None] + n[second] - shared
            top: dict[int, int] = {}

            def root(x: int) -> int:
                while top.get(x, x) != x:
                    x = top[x]
                return x

            for i, j in zip(*np.nonzero(near & (100 * shared >= percent * total))):
                a, b = first[i], second[j]
                x, y = root(int(component[a])), root(int(component[b]))
                if x != y:
                    top[max(x, y)] = min(x, y)
                    found.append((int(node[a]), int(node[b])))
        return pa.table(
            {"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())}
        )

    return run


@dataclass(frozen=True)
class Classes:
    """Classes that may have partners: their texts, and their filters under order 2."""

    texts: DataFrame
    filters: DataFrame

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``node, n, shingles`` of some of them."""
        some = self.texts.join(nodes.select("node").distinct(), "node")
        return materialise(some.mapInArrow(_whole_sets, "node long, n long, shingles array<long>"), "sets")


def _with_centres(bands: DataFrame) -> DataFrame:
    """Every class of a key with the key's centre: ``a, b``; the centre is the class that
    shares most keys with others."""
    sizes = materialise(bands.groupBy("token").agg(F.count("*").alias("size")), "sizes")
    weight = materialise(
        bands.join(sizes, "token").groupBy("node").agg(F.sum("size").alias("weight")), "weights"
    )
    weighted = bands.join(weight, "node")
    centres = materialise(
        weighted.groupBy("token").agg(F.min_by("node", F.struct(-F.col("weight"), "node")).alias("centre")),
        "centres",
    )
    met = bands.join(centres, "token").where("node <> centre")
    return met.groupBy(F.col("node").alias("a"), F.col("centre").alias("b")).agg(F.count("*").alias("keys"))


def _centre_links(pairs: DataFrame, classes: Classes, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to the centres, and the components they make."""
    best = materialise(pairs.groupBy("a").agg(F.max_by("b", F.struct("keys", "b")).alias("b")), "best")
    links = _verified(best, classes, percent)
    grouped = materialise(components(links), "components")
    others = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        names = grouped.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        others = others.join(names, end, "left")
    apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    more = _verified(materialise(others.where(apart).select("a", "b"), "pairs"), classes, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        grouped = materialise(components(links), "components")
    return links, grouped


def _verified(pairs: DataFrame, classes: Classes, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that pass the filter of order 2 and share enough; ``b``
    are few classes."""

    def met(frame: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        def side(name: str) -> DataFrame:
            return rows.select(
                F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                *[F.col(c).alias(f"{c}_{name}") for c in columns],
            )

        ends = materialise(frame.select("b").distinct(), "ends")
        return frame.join(side("a"), "a").join(side("b").join(ends, "b"), "b")

    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    least = _filter_counts_columns(F.least("n_a", "n_b"), percent)[1]
    lost = [_filter_counts_columns(F.col(f"n_{x}"), percent)[0] - F.size(f"second_{x}") for x in "ab"]
    enough = F.size(F.array_intersect("second_a", "second_b")) + lost[0] + lost[1] >= least
    passed = met(pairs, classes.filters, "second", "bits").where(close & enough)
    passed = passed.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(
        _bits_fit(percent), "a long, b long"
    )
    passed = materialise(passed, "candidates")
    sets = classes.sets(passed.select(F.explode(F.array("a", "b")).alias("node")))
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    linked = met(passed, sets, "shingles").where(
        100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)
    )
    return materialise(linked.select("a", "b"), "links")


def _filter_counts_columns(n, percent: int):
    """``filter_counts`` as columns."""
    need = F.floor((n * percent + 99) / 100)
    common = F.least(need, F.floor((n - need) / 2) + 1)
    return n - need + common, common


def _open_keys(bands: DataFrame) -> DataFrame:
    """Rows of the keys that hold several components; of keys with equal classes, one."""
    kinds = bands.groupBy("token").agg(
        F.count("*").alias("members"), F.min("component").alias("least"),
        F.max("component").alias("most"),
        *[F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"sum{k}") for k in (0, 1)],
    )
    # Of two classes, one was the centre.
    kinds = kinds.where("members > 2 and least < most")
    chosen = kinds.groupBy("members", "sum0", "sum1").agg(F.min("token").alias("token"))
    return bands.join(materialise(chosen.select("token"), "open_keys"), "token")


def _compared(rows: DataFrame, classes: Classes, percent: int) -> DataFrame:
    """Links of the open keys, from every two blocks of a key that hold alike sizes."""
    # Linked sets lie in one step of this scale or in neighbouring ones.
    step = F.floor(F.log(F.col("n")) / float(np.log(100 / percent)) + 1e-9).cast("int")
    most = F.greatest(F.lit(1), F.least(F.lit(MEMBERS), F.floor(SHINGLES / F.pow(F.lit(100 / percent), F.col("step") + 1))))
    rows = rows.join(classes.filters.select("node", "n"), "node").withColumn("step", step)
    counts = rows.groupBy("token", "step").agg(F.count("*").alias("members"))
    counts = materialise(
        counts.select("token", "step", F.ceil(F.col("members") / most).cast("int").alias("blocks")), "blocks"
    )
    above = counts.select("token", (F.col("step") - 1).alias("step"), F.col("blocks").alias("above"))
    below = counts.select("token", (F.col("step") + 1).alias("step"), F.col("blocks").alias("below"))
    around = materialise(
        counts.join(above, ["token", "step"], "left").join(below, ["token", "step"], "left"), "around"
    )
    dealt = rows.join(around, ["token", "step"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )

    def others(count, low, high):
        """Meetings of the row's block with the blocks of a step."""
        numbers = F.sequence(F.lit(0), F.coalesce(count, F.lit(0)) - 1)
        made = F.transform(numbers, lambda j: F.struct(*low(j), *high(j)))
        return F.when(F.coalesce(count, F.lit(0)) > 0, made).otherwise(F.array().cast(_MEETING))

    own = lambda j: (F.col("step").alias("s"), F.least("block", j).alias("i"))
    same = others(F.col("blocks"), own, lambda j: (F.col("step").alias("t"), F.greatest(F.col("block"), j).alias("j")))
    up = others(
        F.col("above"), lambda j: (F.col("step").alias("s"), F.col("block").alias("i")),
        lambda j: ((F.col("step") + 1).alias("t"), j.alias("j")),
    )
    down = others(
        F.col("below"), lambda j: ((F.col("step") - 1).alias("s"), j.alias("i")),
        lambda j: (F.col("step").alias("t"), F.col("block").alias("j")),
    )
    met = dealt.withColumn("meeting", F.explode(F.concat(same, up, down))).select(
        "token", "node", "component", "meeting.*", F.xxhash64("step", "block").alias("of_block")
    )
    met = met.join(classes.filters, "node").select(*_MEMBERS, "bits")
    meeting = ["token", "s", "i", "t", "j"]
    possible = met.groupBy(*meeting).applyInArrow(
        _possible_in_block(percent),
        "token long, s int, i int, t int, j int, node long, component long, n long, of_block long",
    )
    possible = materialise(possible, "possible")
    whole = possible.join(classes.sets(possible).select("node", "shingles"), "node")
    found = whole.groupBy(*meeting).applyInArrow(_links_in_block(percent), "a long, b long")
    return materialise(found.distinct(), "links")


_MEETING = "array<struct<s: int, i: int, t: int, j: int>>"


def _named_documents(docs: DataFrame, counters: int) -> tuple[DataFrame, DataFrame, int]:
    """Documents with the names of their sets, classes, and the seed of the names: one under
    which no two sets share a name."""
    seed = 0
    while True:
        rows = materialise(docs.mapInArrow(_named_sets(seed, counters), _SETS), "named")
        named = rows.where("n is not null")
        classes = materialise(
            named.groupBy("node").agg(
                F.min("n").alias("n"), F.min("doc_id").alias("doc_id"),
                F.min(F.struct("doc_id", "text_key")).alias("one"),
                (F.min("other") != F.max("other")).alias("mixed"),
            ),
            "classes",
        )
        if classes.where("mixed").isEmpty():
            return rows, classes.drop("mixed"), seed
        seed += 1


def jaccard_components(docs: DataFrame, percent: int = 80, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each document; documents link from
    ``percent`` hundredths of common shingles on, and a component has its smallest id."""
    spark = T.limit_batches(docs.sparkSession, 4 << 20)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    texts = docs.where("text is not null")
    named, classes, seed = _named_documents(texts, counters)
    counted = named.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
    # ``counters`` rows at most, rarest first.
    top = counted.orderBy(F.col("seen").desc(), "token").limit(counters).collect()[::-1]
    frequent = spark.sparkContext.broadcast(np.array([r.token for r in top], dtype=np.int64).view(np.uint64))
    sent = texts.select("text").mapInArrow(_sent(frequent, percent, seed), "token long, node long, often boolean")
    # A frequent shingle may have any share of the rows: these are dealt by node.
    dealt = sent.repartition(F.when(F.col("often"), F.xxhash64("node")).otherwise(F.col("token")))
    dealt = dealt.sortWithinPartitions("often", "token", "node").select("token", "node", "often")
    shared = materialise(dealt.mapInArrow(_shared_or_often, "token long, node long"), "shared")
    counts = materialise(shared.groupBy("token").agg(F.count("*").alias("held")), "held")
    sent_of, keys_of = _key_counts_columns(F.col("n"), percent)
    of_node = Window.partitionBy("node")  # at most the shingles of one document
    ranked = (
        shared.join(counts, "token")
        .join(classes.select("node", "n"), "node")
        .withColumn("alone", sent_of - F.count("*").over(of_node))
        .withColumn("nth", F.row_number().over(of_node.orderBy("held", "token")))
        .where(F.col("alone") + F.col("nth") <= keys_of)
    )
    bands = materialise(ranked.select("token", "node"), "bands")
    several = bands.groupBy("token").agg(F.count("*").alias("nodes")).where("nodes > 1").select("token")
    bands = materialise(bands.join(materialise(several, "several"), "token"), "bands")
    wanted = bands.select("node").distinct().join(classes, "node").select("node", "one.*")
    met = texts.alias("t").join(
        wanted.alias("w"),
        F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.text_key") == F.col("w.text_key")),
    )
    texts = materialise(met.select("w.node", "t.text").dropDuplicates(["node"]), "texts")
    filters = texts.mapInArrow(_filters(frequent, percent), "node long, n long, second array<int>, bits binary")
    found = Classes(texts, materialise(filters, "filters"))
    links, grouped = _centre_links(materialise(_with_centres(bands), "pairs"), found, percent)
    with_component = bands.join(grouped, "node", "left").select(
        "token", "node", F.coalesce("component", "node").alias("component")
    )
    open_rows = materialise(_open_keys(materialise(with_component, "bands")), "open")
    further = _compared(open_rows, found, percent)
    if not further.isEmpty():
        grouped = materialise(components(links.unionByName(further)), "components")
    in_components = classes.join(grouped, "node", "left").select(
        "node", "n", "doc_id", F.coalesce("component", "node").alias("component")
    )
    in_components = materialise(in_components, "classes")
    least = in_components.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = materialise(
        in_components.join(least, "component").select("node", "component_id"), "of_class"
    )
    with_words = named.where("n is not null").join(of_class, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
    wordless = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return with_words.unionByName(
        wordless.select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )


def _key_counts_columns(n, percent: int):
    """``key_counts`` as columns."""
    need = lambda x: F.floor((x * percent + 99) / 100)
    extra = lambda x: F.least(need(x), F.floor((x - need(x)) / 4) + 1)
    sent = n - need(n) + extra(n)
    return sent, sent - extra(need(n)) + 1


def _shared_or_often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of frequent shingles, each once; of the others, those of several nodes."""
    often: list[pa.RecordBatch] = []

    def rare() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = batch.column("often").to_numpy(zero_copy_only=False)
            split = int(np.searchsorted(flags, True))  # sorted: the others come first
            if split < len(flags):
                often.append(batch.slice(split))
            if split:
                yield batch.slice(0, split)
            if often:
                break

    yield from _shared(rare())

    def rest() -> Iterator[pa.RecordBatch]:
        yield from often
        yield from batches

    last = None
    for batch in rest():
        tokens, nodes = (batch.column(c).to_numpy() for c in ("token", "node"))
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
        new[0] = last is None or (tokens[0], nodes[0]) != last
        last = tokens[-1], nodes[-1]
        yield pa.RecordBatch.from_arrays([pa.array(tokens[new]), pa.array(nodes[new])], ["token", "node"])
