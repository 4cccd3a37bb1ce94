"""Hard negatives of anchors, mined by a secondary-sort shuffle.

A pair of an anchor and another row has a score, the inner product of their vectors after
each component ``x`` became ``floor(scale * x)``, so scores are integers and ties are real.

1. Anchors are numbered into blocks and packed, as are the vectors into chunks; every chunk
   meets every block in a task, never a vector an anchor as a row of its own. Blocks go out
   in rounds of ``ROUND`` blocks, so what is broadcast has a fixed size; each round writes
   its own table, and the plan of a round doesn't grow with the data.
2. The first pass finds the positives: each task keeps the best few rows of the anchor's
   label, the shuffle merges them.
3. The second pass knows the positives' scores. Of the rows with another label a task keeps
   those that are among its first few in some positive's window; no other row can be among
   the first few of all tasks.
4. What is left is packed into keys ``(anchor, descending score, kind, id)``, dealt by
   anchor and sorted within partitions. An iterator reads the keys in order: a positive
   opens a window, a negative goes to each open window it lies in, until that is full. It
   holds the open windows of one anchor and nothing else.

Defined cases: rows with a null id, label or vector, or with a component that is null
or not finite (also once scaled) take no part. Rows equal in id, label and vector are one row; others that share an id are
rows of their own, also as anchors. Vectors of different lengths are never compared. An
anchor without other rows of its label has no result, and a positive whose window is empty
(each of negative score, for instance) has none. Scores are exact at any size; beyond 64
bits they are held at the largest or smallest long. Other columns are ignored, and an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tokens import limit_batches
from starloom.session import materialise

BLOCK = 512  # anchors packed in a row
CHUNK = 2048  # vectors packed in a row
ROUND = 32  # blocks broadcast at once
LEAST, MOST = -(1 << 63), (1 << 63) - 1
_SIGN = np.uint64(1 << 63)
_KEY = np.dtype([("anchor", ">u8"), ("row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1


def usable(
    vectors: DataFrame, scale: float, id_column: str, vector_column: str, label_column: str
) -> DataFrame:
    """``id, label, vector, print`` of the rows that take part; ``print`` tells rows of one
    id apart."""
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{label_column}`").cast("long").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).dropna()
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    rows = rows.where(~bad).dropDuplicates()
    # Taken from the values before rounding: rows that differ stay apart.
    return rows.select("id", "label", F.xxhash64("label", "vector").alias("print"), "vector").withColumn(
        "vector", F.transform("vector", lambda x: _floored(x, scale))
    )


def _floored(x, scale: float):
    # floor() of Spark gives a long; a component may be larger than that.
    times = x * F.lit(float(scale))
    return F.when(F.abs(times) < F.lit(float(1 << 53)), F.floor(times).cast("double")).otherwise(times)


def _bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _pack(batch: pa.RecordBatch | pa.Table, most: int):
    """Rows of at most ``most`` vectors each, all of one length."""
    sizes = np.diff(_offsets(batch.column("vector")))
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        for first in range(0, len(rows), most):
            part = batch.take(pa.array(rows[first : first + most]))
            flat = _whole(part.column("vector")).flatten().to_numpy(zero_copy_only=False)
            yield part, {
                "dims": dims,
                "n": part.num_rows,
                "ids": _bytes(_whole(part.column("id")).to_numpy()),
                "prints": _bytes(_whole(part.column("print")).to_numpy()),
                "labels": _bytes(_whole(part.column("label")).to_numpy()),
                "vectors": _bytes(flat.astype(np.float64)),
            }


def _whole(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _offsets(column) -> np.ndarray:
    return _whole(column).offsets.to_numpy()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, row in _pack(batch, CHUNK):
            yield pa.RecordBatch.from_pylist([row], schema=_CHUNK_SCHEMA)


_CHUNK_SCHEMA = pa.schema(
    [("dims", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("prints", pa.binary()),
     ("labels", pa.binary()), ("vectors", pa.binary())]
)
_BLOCK_SCHEMA = pa.schema(
    [("dims", pa.int32()), ("block", pa.int32()), ("turn", pa.int32()), ("n", pa.int32()),
     ("ids", pa.binary()), ("prints", pa.binary()), ("labels", pa.binary()),
     ("vectors", pa.binary()), ("positives", pa.binary())]
)


def _blocks(positives: int):
    """Packs the anchors of a block; ``positives`` scores for each, missing ones null."""

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for part, row in _pack(table, BLOCK):
            scores = np.zeros((part.num_rows, positives), dtype=np.int64)
            known = np.zeros((part.num_rows, positives), dtype=bool)
            if "scores" in part.column_names:
                for i, have in enumerate(part.column("scores").to_pylist()):
                    for j, score in enumerate(have or []):
                        scores[i, j], known[i, j] = score, True
            row |= {"block": part.column("block")[0].as_py(), "turn": part.column("turn")[0].as_py()}
            row["positives"] = _bytes(scores) + _bytes(known)
            rows.append(row)
        return pa.Table.from_pylist(rows, schema=_BLOCK_SCHEMA)

    return run


@dataclass
class Packed:
    """Vectors of a chunk or a block, unpacked."""

    ids: np.ndarray
    prints: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int, prefix: str) -> Packed:
        def raw(name: str, kind):
            return np.frombuffer(batch.column(prefix + name)[row].as_buffer(), dtype=kind)

        n, dims = batch.column(prefix + "n")[row].as_py(), batch.column("dims")[row].as_py()
        return cls(
            raw("ids", np.int64), raw("prints", np.int64), raw("labels", np.int64),
            raw("vectors", np.float64).reshape(n, dims),
        )


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, in 64 bits."""
    dims = left.shape[1]
    most = np.abs(left).max(initial=0.0) * np.abs(right).max(initial=0.0) * max(dims, 1)
    if most < 1 << 53:  # every partial sum is exact
        return (left @ right.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    x, y = (whole(v) if v.size else v.astype(object) for v in (left, right))
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for i in range(len(left)):
        for j in range(len(right)):
            out[i, j] = min(MOST, max(LEAST, sum(a * b for a, b in zip(x[i], y[j]))))
    return out


@dataclass
class Best:
    """The best ``k`` rows found so far for each column: high scores first, then small ids."""

    columns: int
    k: int
    column: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    id: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    bar: np.ndarray = field(init=False)

    def __post_init__(self):
        self.bar = np.full(self.columns, LEAST)

    def add(self, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, first: int = 0) -> None:
        """Scores of rows (down) for the columns from ``first`` on (across), where they fit."""
        fits = fits & (scores >= self.bar[first : first + scores.shape[1]])
        crowded = np.flatnonzero(fits.sum(axis=0) > self.k)
        if len(crowded):
            # Only the best k of these rows, and those that tie with the k-th, can stay.
            some = np.where(fits[:, crowded], scores[:, crowded], LEAST)
            at = len(ids) - self.k
            fits[:, crowded] &= some >= np.partition(some, at, axis=0)[at]
        row, column = np.nonzero(fits)
        if not len(row):
            return
        column_all = np.concatenate([self.column, column + first])
        score_all = np.concatenate([self.score, scores[row, column]])
        id_all = np.concatenate([self.id, ids[row]])
        # ~score falls as the score rises, and can't overflow.
        order = np.lexsort((id_all, ~score_all, column_all))
        column_all = column_all[order]
        nth = np.arange(len(order)) - np.searchsorted(column_all, column_all)
        kept = nth < self.k
        order, nth = order[kept], nth[kept]
        self.column, self.score, self.id = column_all[kept], score_all[order], id_all[order]
        full = nth == self.k - 1
        self.bar[self.column[full]] = self.score[full]


def keys(anchors: Packed, column: np.ndarray, score: np.ndarray, ids: np.ndarray, kind: int):
    """Packed keys, whose order as bytes is: anchor, score from high to low, positives before
    negatives, id."""
    out = np.zeros(len(column), dtype=_KEY)
    out["anchor"] = anchors.ids[column].astype(np.uint64) ^ _SIGN
    out["row"] = anchors.prints[column].astype(np.uint64) ^ _SIGN
    out["score"] = ~(score.astype(np.uint64) ^ _SIGN)
    out["kind"] = kind
    out["id"] = ids.astype(np.uint64) ^ _SIGN
    raw = out.tobytes()
    size = _KEY.itemsize
    return pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())


def unpacked(key: bytes) -> tuple[bytes, int, int, int, int]:
    """Anchor (id and print, as bytes), its id, score, kind and id of a key."""
    one = np.frombuffer(key, dtype=_KEY)[0]
    signed = lambda v: int(v) - (1 << 63)
    return key[:16], signed(one["anchor"]), (1 << 64) - 1 - int(one["score"]) - (1 << 63), int(one["kind"]), signed(one["id"])


def _emit(anchors: Packed, column, score, ids, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors.ids[column]), keys(anchors, column, score, ids, kind)], ["anchor", "key"]
    )


def _met(batches: Iterator[pa.RecordBatch]):
    """Pairs of a chunk and a block, each with the block's number and positives."""
    for batch in batches:
        for row in range(batch.num_rows):
            block = batch.column("block")[row].as_py(), batch.column("dims")[row].as_py()
            yield (
                block, Packed.read(batch, row, ""), Packed.read(batch, row, "a_"),
                batch.column("a_positives")[row].as_py(),
            )


def _best_positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[Packed, Best]] = {}
        for block, rows, anchors, _ in _met(batches):
            if block not in found:
                found[block] = anchors, Best(len(anchors.ids), k)
            own = (rows.ids[:, None] == anchors.ids) & (rows.prints[:, None] == anchors.prints)
            fits = (rows.labels[:, None] == anchors.labels) & ~own
            if fits.any():
                found[block][1].add(inner_products(rows.vectors, anchors.vectors), fits, rows.ids)
        for anchors, best in found.values():
            yield _emit(anchors, best.column, best.score, best.id, POSITIVE)

    return run


def _times(scores: np.ndarray, by: int) -> np.ndarray:
    """Scores times a small number, as whole numbers of any size if need be."""
    if np.abs(scores.astype(np.float64)).max(initial=0.0) * by < 1 << 62:
        return scores * by
    return scores.astype(object) * by


def _best_negatives(k: int, positives: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[Packed, Best]] = {}
        for block, rows, anchors, raw in _met(batches):
            n = len(anchors.ids)
            scores = np.frombuffer(raw[: 8 * n * positives], dtype=np.int64).reshape(n, positives)
            known = np.frombuffer(raw[8 * n * positives :], dtype=bool).reshape(n, positives)
            if block not in found:
                found[block] = anchors, Best(n * positives, k)
            other = rows.labels[:, None] != anchors.labels
            if not other.any():
                continue
            product = inner_products(rows.vectors, anchors.vectors)
            hundred = _times(product, 100)
            for j in range(positives):
                inside = (hundred <= _times(scores[:, j], high)) & (hundred >= _times(scores[:, j], low))
                fits = other & known[:, j] & inside.astype(bool)
                found[block][1].add(product, fits, rows.ids, j * n)
        for anchors, best in found.values():
            # A row may be among the first of several windows: it is sent once, as often as
            # the table holds it.
            column = best.column % len(anchors.ids)
            window = best.column // len(anchors.ids)
            order = np.lexsort((window, best.id, best.score, column))
            column, score, ids, window = column[order], best.score[order], best.id[order], window[order]
            yield _emit(anchors, *_once(column, score, ids, window), NEGATIVE)

    return run


def _once(column, score, ids, window):
    """Each row as often as the window that holds it most often has it."""
    same = np.zeros(len(column), dtype=bool)
    same[1:] = (column[1:] == column[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1])
    group = np.cumsum(~same)
    counts: dict[tuple[int, int], int] = {}
    most: dict[int, int] = {}
    for g, w in zip(group.tolist(), window.tolist()):
        counts[g, w] = counts.get((g, w), 0) + 1
        most[g] = max(most.get(g, 0), counts[g, w])
    first = np.flatnonzero(~same)
    rows = np.repeat(first, [most[g] for g in group[first].tolist()]) if len(first) else first
    return column[rows], score[rows], ids[rows]


def _windows(positives: int, negatives: int, low: int, high: int):
    """Reads sorted keys; holds the open windows of one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_windows, opened = None, [], 0
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                row, anchor, score, kind, id_ = unpacked(key)
                if row != at:
                    at, open_windows, opened = row, [], 0
                if kind == POSITIVE:
                    if opened < positives:
                        opened += 1
                        open_windows.append([id_, score, 0])
                    continue
                for window in open_windows:
                    if low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], id_, window[1], score))
                # A full window closes, and one that all further scores lie below.
                open_windows = [
                    w for w in open_windows if w[2] < negatives and low * w[1] <= 100 * score
                ]
            if out:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_RESULT.names, x)) for x in out], schema=_RESULT
                )

    return run


_RESULT = pa.schema(
    [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
     ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())]
)
_RESULT_DDL = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


def _against(chunks: DataFrame, blocks: DataFrame, turn: int, work, name: str) -> DataFrame:
    """What ``work`` finds where the chunks meet the blocks of a round."""
    now = blocks.where(F.col("turn") == turn).select(
        "dims", "block",
        *[F.col(c).alias(f"a_{c}") for c in ("n", "ids", "prints", "labels", "vectors", "positives")],
    )
    met = chunks.join(F.broadcast(now), "dims")  # ROUND blocks of at most BLOCK anchors
    return materialise(met.mapInArrow(work, "anchor long, key binary"), name)


def _sorted(pairs: list[DataFrame]) -> DataFrame:
    every = pairs[0]
    for more in pairs[1:]:
        every = every.unionByName(more)
    return every.repartition("anchor").sortWithinPartitions("key").select("key")


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``; their positives the best
    ``positives`` other rows of their label; for each, the best ``negatives`` rows of another
    label whose score is ``low`` to ``high`` percent of the positive's. Ties go to the
    smaller id.
    """
    spark = vectors.sparkSession
    limit_batches(spark, 4 << 20)
    rows = materialise(usable(vectors, scale, id_column, vector_column, label_column), "vectors")
    chosen = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-chosen.count() // BLOCK))
    turns = -(-blocks // ROUND)
    anchors = materialise(
        chosen.repartition(blocks)
        .withColumn("block", F.spark_partition_id())
        .withColumn("turn", (F.col("block") % turns).cast("int")),
        "anchors",
    )
    chunks = materialise(rows.mapInArrow(_chunks, _ddl(_CHUNK_SCHEMA)), "chunks")
    packed = materialise(
        anchors.groupBy("block").applyInArrow(_blocks(positives), _ddl(_BLOCK_SCHEMA)), "blocks"
    )
    near = [
        _against(chunks, packed, turn, _best_positives(positives), "positives")
        for turn in range(turns)
    ]

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, have = None, 0
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                row, anchor, score, _, _ = unpacked(key)
                at, have = (at, have + 1) if row == at else (row, 1)
                if have <= positives:
                    print_ = int.from_bytes(row[8:], "big") - (1 << 63)
                    out.append({"id": anchor, "print": print_, "score": score, "key": key})
            if out:
                yield pa.RecordBatch.from_pylist(
                    out, schema=pa.schema([("id", pa.int64()), ("print", pa.int64()),
                                           ("score", pa.int64()), ("key", pa.binary())])
                )

    known = materialise(
        _sorted(near).mapInArrow(first_ones, "id long, print long, score long, key binary"), "known"
    )
    # At most ``positives`` scores for an anchor.
    scores = known.groupBy("id", "print").agg(F.collect_list("score").alias("scores"))
    packed = materialise(
        anchors.join(scores, ["id", "print"])
        .groupBy("block")
        .applyInArrow(_blocks(positives), _ddl(_BLOCK_SCHEMA)),
        "blocks",
    )
    work = _best_negatives(negatives, positives, low, high)
    far = [_against(chunks, packed, turn, work, "negatives") for turn in range(turns)]
    ordered = _sorted([known.select(F.col("id").alias("anchor"), "key"), *far])
    return ordered.mapInArrow(_windows(positives, negatives, low, high), _RESULT_DDL)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)
