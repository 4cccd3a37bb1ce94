"""Near-duplicate documents by Order MinHash.

A document is the sequence of its five-word shingles, each labelled with its occurrence
number, so that repeats count. A sketch draws the ``picks`` smallest shingles under a hash
function and keeps them in text order: two documents agree on it if they share these
shingles and their order, which follows edit similarity. Pairs of sketches make a band.

1. Documents with the same words are one class, and only classes are compared.
2. Classes that agree on a band are candidates. In each band key one class is the centre,
   and every other is compared with it: a row for each class, never pairs.
3. A candidate is verified by banded alignment of the two shingle sequences. Labelled
   shingles are unique, so the best alignment is the longest increasing run of matched
   positions; only matches as far off the diagonal as the threshold allows are looked at.
   Similarity is aligned shingles over all shingles of both, at least ``threshold``.
4. In keys that still hold several components, every two classes of different components
   are compared, in blocks of bounded size, by parity bitmaps of their shingles: bits that
   differ are no more than shingles that differ, so no pair at the threshold is ruled out.
   What the bitmaps leave is verified: first the best of each class, for as long as that
   joins many, then all. Each key is done when all its classes are, whatever others hold.

All links together give the classes. A link is missed only where two texts share no band
key: at similarity 0.8 with a chance of about 2 in 10,000, falling fast above. The work of
step 4 grows with the square of the classes in a key that the centre did not join.

Words are letters, digits and all that is not ASCII, A-Z folded to a-z.

Defined cases: a document of one to four words has one shingle, of all its words; one
without words, or with a null text, is in a class of its own; a null id never names a
class while a real one is there; rows that repeat id and text are copies, of which one
stays. Other columns are handed on by ``drop_near_duplicates``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import tokens as T
from starloom.llm.components import components
from starloom.session import materialise

SHINGLE = 5
MEMBERS = 512  # classes in a block of a key
BITS = (256, 1 << 16)  # least and most of a parity bitmap
BATCH = 4 << 20  # bytes of text handed to a worker at a time
_FAR = np.uint64((1 << 64) - 1)
_BLOCK = 1 << 16  # hash values worked on at a time, unless one function needs more


def labelled_shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of a document, in order, with their occurrence number."""
    if not len(hashes):
        return hashes
    shingles = T.sequences(hashes, min(SHINGLE, len(hashes)))
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if not new.all():
        first = np.flatnonzero(new)
        nth = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
        again = nth > 0
        ordered = ordered.copy()
        ordered[again] = T.mixed(ordered[again] + nth[again].astype(np.uint64))
        shingles = shingles.copy()
        shingles[order] = ordered
    return shingles


def order_minhash(shingles: np.ndarray, factors: np.ndarray, picks: int) -> np.ndarray:
    """One sketch value for each hash function."""
    out = np.zeros(len(factors), dtype=np.uint64)
    step = max(1, _BLOCK // len(shingles))
    picks = min(picks, len(shingles))
    for first in range(0, len(factors), step):
        some = factors[first : first + step]
        values = shingles[None, :] * some[:, None]
        values ^= values >> np.uint64(29)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        rows = np.arange(len(some))
        places = np.empty((picks, len(some)), dtype=np.int64)
        for k in range(picks):
            places[k] = values.argmin(axis=1)
            values[rows, places[k]] = _FAR
        places.sort(axis=0)  # in text order
        total = np.zeros(len(some), dtype=np.uint64)
        for k in range(picks):
            total = T.mixed(total + shingles[places[k]])
        out[first : first + step] = total
    return out


def band_keys(sketches: np.ndarray, per_band: int) -> np.ndarray:
    bands = sketches.reshape(-1, per_band)
    total = np.arange(len(bands), dtype=np.uint64)
    for k in range(per_band):
        total = T.mixed(total + bands[:, k])
    return total


def factors_of(count: int, seed: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketched(
    docs: DataFrame, bands: int = 16, per_band: int = 2, picks: int = 2, seed: int = 11
) -> DataFrame:
    """``doc_id, text_key, node, keys`` for each document that has words; ``node`` names the
    sequence of words."""
    T.limit_batches(docs.sparkSession, BATCH)
    factors = factors_of(bands * per_band, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.words(batch.column("text"), T.PLAIN_TABLE, T.PLAIN_FOLD):
                hashes = piece.hashes()
                some = np.flatnonzero(np.diff(piece.bounds))
                if not len(some):
                    continue
                low, high = piece.bounds[some], piece.bounds[some + 1]
                first = T.spans_hash(hashes, low, high)
                second = T.spans_hash(T.mixed(hashes + np.uint64(1)), low, high)
                nodes = np.stack([first, second], axis=1).astype(">u8")
                keys = np.concatenate(
                    [
                        band_keys(
                            order_minhash(labelled_shingles(hashes[a:b]), factors, picks), per_band
                        )
                        for a, b in zip(low, high)
                    ]
                )
                rows = pa.array(some + piece.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("text_key").take(rows),
                     pa.array([n.tobytes() for n in nodes], pa.binary()),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands),
                         pa.array(keys.view(np.int64)))],
                    ["doc_id", "text_key", "node", "keys"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    ).where("text is not null")
    return rows.mapInArrow(run, "doc_id long, text_key long, node binary, keys array<long>")


def aligned(left: np.ndarray, right: np.ndarray, threshold: float) -> int:
    """Shingles that the best alignment matches; 0 if it can't reach the threshold."""
    total = len(left) + len(right)
    need = threshold * total / (1 + threshold)  # matched shingles at the threshold
    if min(len(left), len(right)) < need - 1e-9:
        return 0
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    # A match at distance d from the diagonal leaves d shingles unmatched at least.
    near = np.abs(i - j) <= total - 2 * need + 1e-9
    j = j[near]
    if len(j) < need - 1e-9:
        return 0
    if (np.diff(j) > 0).all():
        return len(j)
    ends: list[int] = []
    for place in j.tolist():
        at = bisect_left(ends, place)
        if at == len(ends):
            ends.append(place)
        else:
            ends[at] = place
    return len(ends)


def similarity(left: np.ndarray, right: np.ndarray, threshold: float) -> float:
    """Aligned shingles over all shingles; 0 below the threshold."""
    matched = aligned(left, right, threshold)
    found = matched / (len(left) + len(right) - matched) if matched else 0.0
    return found if found >= threshold - 1e-12 else 0.0


def _shingles(column) -> list[np.ndarray]:
    out = []
    for piece in T.words(column, T.PLAIN_TABLE, T.PLAIN_FOLD):
        hashes = piece.hashes()
        out += [labelled_shingles(hashes[a:b]) for a, b in zip(piece.bounds, piece.bounds[1:])]
    return out


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _shingles(batch.column("text_a")), _shingles(batch.column("text_b"))
            scores = [similarity(x, y, threshold) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b")), pa.array(scores, pa.float64())],
                ["a", "b", "score"],
            )

    return run


def _with_centres(bands: DataFrame) -> DataFrame:
    """Every node of a band key with the key's centre: ``a, b``.

    The centre is the node that shares most keys with others: in a group of copies that is
    the text they were made from, to which they are closer than to each other.
    """
    order = F.struct(-F.col("shared"), "node")
    chosen = materialise(bands.groupBy("key").agg(F.min_by("node", order).alias("centre")), "centres")
    joined = bands.join(chosen, "key").where("node <> centre")
    return joined.select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")
    ).distinct()


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each rest of the hashes by a power of two: whether it occurs an odd number
    of times. Bitmaps of two sets differ in no more bits than the sets do in elements."""
    least, most = BITS
    width = min(most, max(least, 1 << (4 * len(shingles) - 1).bit_length()))
    places = (shingles & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, bits = [], []
        for shingles in _shingles(batch.column("text")):
            sizes.append(len(shingles))
            bits.append(parity_bitmap(shingles))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
            ["node", "size", "bits"],
        )


def _matrix(bits: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of one size as rows of words, folded to ``width`` bytes."""
    rows = np.frombuffer(b"".join(bits), dtype=np.uint8).reshape(len(bits), -1)
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return np.ascontiguousarray(rows).view(np.uint64)


def likely_pairs(
    component: np.ndarray, block: np.ndarray, size: np.ndarray, bits: list[bytes],
    threshold: float, best: bool,
) -> list[tuple[int, int]]:
    """Pairs of rows in different components that the bitmaps don't rule out; the rows are
    one block (every two are compared) or two (only across). ``best``: for each row only
    the pair whose bitmaps differ least."""
    first = np.flatnonzero(block == block[0])
    second = np.flatnonzero(block != block[0])
    alone = not len(second)
    second = first if alone else second
    widths = np.array([len(x) for x in bits])
    out = []
    for one in np.unique(widths[first]).tolist():
        lefts = first[widths[first] == one]
        for other in np.unique(widths[second]).tolist():
            if alone and other < one:
                continue
            rights = second[widths[second] == other]
            width = min(one, other)
            x = _matrix([bits[i] for i in lefts], width)
            y = _matrix([bits[i] for i in rights], width)
            for n, i in enumerate(lefts.tolist()):
                short, long = np.minimum(size[i], size[rights]), np.maximum(size[i], size[rights])
                fit = (component[rights] != component[i]) & (short >= threshold * long - 1e-9)
                if alone and one == other:
                    fit &= rights > i
                some = np.flatnonzero(fit)
                if not len(some):
                    continue
                differ = np.bitwise_count(y[some] ^ x[n]).sum(axis=1, dtype=np.int64)
                total = size[i] + size[rights[some]]
                # As in aligned(): shingles that may be unmatched at the threshold.
                near = differ <= total * (1 - threshold) / (1 + threshold) + 1e-9
                some, share = some[near], differ[near] / total[near]
                out += [(d, i, j) for d, j in zip(share.tolist(), rights[some].tolist())]
    if best:
        seen: set[int] = set()
        kept = []
        for d, i, j in sorted(out):
            if i not in seen or j not in seen:
                kept.append((d, i, j))
                seen |= {i, j}
        out = kept
    return [(i, j) for _, i, j in out]


def _within_blocks(threshold: float, best: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members").slice(row, 1).flatten()
                node, component, block, size, bits = members.flatten()
                code = component.dictionary_encode().indices.to_numpy()
                pairs = likely_pairs(
                    code, block.to_numpy(), size.to_numpy(), bits.to_pylist(), threshold, best
                )
                if pairs:
                    i, j = (pa.array(x) for x in zip(*pairs))
                    yield pa.RecordBatch.from_arrays(
                        [node.take(i), node.take(j)], ["x", "y"]
                    )

    return run


def _across_components(
    bands: DataFrame, bitmaps: DataFrame, threshold: float, best: bool
) -> DataFrame:
    """Pairs ``a, b`` of the keys' nodes in different components that may reach the
    threshold: each key is dealt to blocks, and each two blocks are compared."""
    keys = bands.groupBy("key").agg(
        F.count("*").alias("members"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    # Of two nodes, one was the centre.
    keys = keys.where("members > 2 and least < most").select(
        "key", F.ceil(F.col("members") / MEMBERS).cast("int").alias("blocks")
    )
    rows = bands.join(materialise(keys, "open_keys"), "key").select(
        "key", "node", "component", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    rows = rows.join(bitmaps, "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    groups = rows.groupBy(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    ).agg(F.collect_list(F.struct("node", "component", "block", "size", "bits")).alias("members"))
    found = groups.select("members").mapInArrow(
        _within_blocks(threshold, best), "x binary, y binary"
    )
    return found.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).distinct()


def _band_rows(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, node, component, shared`` for the keys of more than one node, where ``shared``
    counts the nodes met in all keys of a node; and ``node, shared`` alone."""
    bands = nodes.select("node", F.explode("keys").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    bands = materialise(bands.join(materialise(sizes, "keys"), "key"), "bands")
    shared = materialise(bands.groupBy("node").agg(F.sum("size").alias("shared")), "shared")
    rows = bands.join(shared, "node").select(
        "key", "node", F.col("node").alias("component"), "shared"
    )
    return materialise(rows, "bands"), shared


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``a, b`` that reach the threshold."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    found = (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(threshold), "a binary, b binary, score double")
        .where("score > 0")
        .select("a", "b")
    )
    return materialise(found, "verified")


def _named(bands: DataFrame, names: DataFrame) -> DataFrame:
    """The rows with the components of their nodes."""
    joined = bands.join(names.select("node", F.col("component").alias("name")), "node", "left")
    return materialise(
        joined.select("node", "key", F.coalesce("name", "node").alias("component")), "bands"
    )


def near_duplicate_classes(
    docs: DataFrame, threshold: float = 0.8, **sketch
) -> DataFrame:
    """``doc_id, text_key, node, class_id, n_copies, kept_node`` for each document with words:
    the smallest id of its class, rows with the same words, and the words that stay for the
    class."""
    rows = materialise(sketched(docs, **sketch), "sketches")
    nodes = materialise(
        rows.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"),
            F.count("*").alias("n_copies"),
            F.first("keys").alias("keys"),
        ),
        "nodes",
    )
    # Bands in which a class is alone are done with.
    bands, shared = _band_rows(nodes)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    first = nodes.select("node", "first.doc_id", "first.text_key")
    wanted = first.join(shared.select("node"), "node")
    texts = texts.alias("t").join(
        wanted.alias("w"),
        F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.text_key") == F.col("w.text_key")),
    )
    # Rows that repeat an id and a text all meet the one that names the class: one stays.
    texts = materialise(texts.select("w.node", "t.text").dropDuplicates(["node"]), "texts")
    tried = materialise(_with_centres(bands), "pairs")
    links = _linked(tried, texts, threshold)
    grouped = materialise(components(links), "components")
    bands = _named(bands, grouped)
    keys = bands.groupBy("key").agg(
        F.count("*").alias("members"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    # The other keys are done: components only grow.
    bands = materialise(
        bands.join(keys.where("members > 2 and least < most").select("key"), "key"), "open"
    )
    bitmaps = texts.join(bands.select("node").distinct(), "node").mapInArrow(
        _bitmaps, "node binary, size long, bits binary"
    )
    bitmaps = materialise(bitmaps, "bitmaps")
    best = True
    while True:
        pairs = _across_components(bands, bitmaps, threshold, best).join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        found = _linked(pairs, texts, threshold)
        n_pairs, n_found = pairs.count(), found.count()
        if n_found:
            links = links.unionByName(found)
            grouped = materialise(components(links), "components")
        if not best:
            break
        tried = tried.unionByName(pairs)
        if n_found:
            bands = _named(bands, grouped)
        # Where the best of each bring few links, what is left is compared in full.
        best = n_found > n_pairs / 10
    named = nodes.select("node", "n_copies", "first").join(grouped, "node", "left").select(
        "node", "n_copies", "first", F.coalesce("component", "node").alias("component")
    )
    named = materialise(named, "named")
    kept = named.groupBy("component").agg(F.min(F.struct("first", "node")).alias("least")).select(
        "component", F.col("least.first.doc_id").alias("class_id"), F.col("least.node").alias("kept_node")
    )
    kept = materialise(kept, "kept")
    of_nodes = named.join(kept, "component").select("node", "n_copies", "class_id", "kept_node")
    return rows.select("doc_id", "text_key", "node").join(materialise(of_nodes, "of_nodes"), "node")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, **sketch) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_copies, kept``. Documents
    without words are classes of their own, without copies."""
    found = near_duplicate_classes(docs, threshold, **sketch)
    classes = found.select(
        "doc_id", "class_id", "n_copies",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
    )
    blank = docs.where(_wordless()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("doc_id").cast("long").alias("class_id"),
        F.lit(1).cast("long").alias("n_copies"),
        F.lit(True).alias("kept"),
    )
    return classes.unionByName(blank)


def _wordless():
    return F.coalesce(~F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(True))


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, **sketch) -> DataFrame:
    """The documents, one of each class: that of the smallest id. All columns are kept."""
    found = near_duplicate_classes(docs, threshold, **sketch)
    gone = (
        found.groupBy("doc_id", "text_key")
        .agg(
            F.first("node").alias("node"),
            F.first("kept_node").alias("kept_node"),
            F.first("class_id").alias("class_id"),
            F.count("*").alias("rows"),
        )
        .select(
            "doc_id", "text_key", "node", "rows",
            ((F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("stays"),
        )
        .where("not stays or rows > 1")
    )
    gone = materialise(gone, "decisions").alias("g")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
    ).alias("d")
    joined = rows.join(
        gone,
        F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_key") == F.col("g.text_key")),
        "left",
    ).select("doc", "node", "stays")
    columns = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    single = joined.where("node is null").select(*columns)
    again = joined.where("stays").groupBy("node").agg(F.first("doc").alias("doc")).select(*columns)
    return single.unionByName(again)
