"""Nearest neighbours from one bit per dimension.

Index: vectors are taken relative to the mean of all, turned by a random rotation, and only
the sign of each coordinate is kept, packed to bytes, with two correction scalars: the
distance to the mean and the inner product of the unit vector with its code. The mean
covers all rows; the rotation comes from a seed and the number of dimensions, so nothing is
fitted on a sample. Every row is indexed.

Search: queries are dealt to blocks of about a fixed size; each block is read, broadcast to
all index partitions, searched in a job of its own and let go, so neither the driver nor the
plan holds more than one. For every vector, the code gives an estimate of its inner product with the query, and a bound
on the estimate's error that fails with a probability set by ``epsilon``. Vectors whose
lowest possible distance is not above the k-th smallest of the highest possible distances
are reranked by exact distance, in the same task; each partition hands on its best ``k``
for each query, and these are merged.

No number of candidates is capped: equal vectors have equal codes and are all reranked.

Defined cases: vectors that are null, zero, or hold null, NaN or infinite components take
no part, neither do rows with a null id. Only vectors of one length are compared: each
length has its own index. Each different vector of an id that repeats is a candidate, and a
query where the id is one; an id is found once, at the smallest distance, and never by
itself. A table with one vector gives no rows; one with fewer than ``k`` others gives all of
them. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tokens import limit_batches
from starloom.session import materialise, shared_folder

SLICE = 4096  # vectors compared at a time


def rotation(dimensions: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    gauss = np.random.default_rng(seed).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector`` of the rows that take part, equal ones once."""
    good = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return good.where(~bad & F.exists(v, lambda x: x != 0)).distinct()


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, dimensions)


def build_index(
    rows: DataFrame, dimensions: int, seed: int = 7
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Index table (``id, vector, code, norm, fit``) of vectors ``id, vector`` of one length,
    mean and rotation."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dimensions), 0
        for batch in batches:
            block = _matrix(batch.column("vector"), dimensions)
            total += block.sum(axis=0)
            n += len(block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions)), pa.array(total), pa.array(np.full(dimensions, n))],
            ["k", "total", "n"],
        )

    means = (
        rows.select("vector")
        .mapInArrow(sums, "k long, total double, n long")
        .groupBy("k")
        .agg((F.sum("total") / F.sum("n")).alias("mean"))
        .collect()  # one row for each dimension
    )
    mean = np.zeros(dimensions)
    for row in means:
        mean[row.k] = row.mean
    turn = rotation(dimensions, seed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = (_matrix(batch.column("vector"), dimensions) - mean) @ turn
            norm = np.linalg.norm(turned, axis=1)
            size = np.where(norm > 0, norm, 1.0)
            # Inner product of the unit vector with its code, whose entries are +-1/sqrt(d).
            fit = np.abs(turned).sum(axis=1) / (size * np.sqrt(dimensions))
            codes = np.packbits(turned > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(fit)],
                ["id", "vector", "code", "norm", "fit"],
            )

    index = rows.mapInArrow(
        encode, "id long, vector array<double>, code binary, norm double, fit double"
    )
    return materialise(index, "codes"), mean, turn


class _Best:
    """The nearest ``k`` found so far for each query of a block."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.ids = [np.zeros(0, dtype=np.int64)] * queries
        self.scores = [np.zeros(0)] * queries

    def limit(self, q: int) -> float:
        return self.scores[q][-1] if len(self.scores[q]) == self.k else np.inf

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.ids[q], ids])
        scores = np.concatenate([self.scores[q], scores])
        order = np.lexsort((ids, scores))
        _, first = np.unique(ids[order], return_index=True)  # each id where it is nearest
        order = order[np.sort(first)[: self.k]]
        self.ids[q], self.scores[q] = ids[order], scores[order]


def _kth_by_id(ids: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """For each column, the ``k``-th smallest of the ids' smallest values."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
    if len(first) < len(ids):
        high = np.minimum.reduceat(high[order], first, axis=0)
    if len(high) <= k:
        return np.full(high.shape[1], np.inf)
    return np.partition(high, k - 1, axis=0)[k - 1]


def _scan(block, mean: np.ndarray, turn: np.ndarray, k: int, epsilon: float):
    dimensions = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = block.value
        turned = (queries - mean) @ turn
        query_norm = np.linalg.norm(turned, axis=1)
        best = _Best(len(query_ids), k)
        root = np.sqrt(dimensions)
        for batch in batches:
            for first in range(0, len(batch), SLICE):
                part = batch.slice(first, SLICE)
                ids = part.column("id").to_numpy()
                vectors = _matrix(part.column("vector"), dimensions)
                norm = part.column("norm").to_numpy()
                fit = np.maximum(part.column("fit").to_numpy(), 1e-12)
                packed = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint8)
                signs = np.unpackbits(packed.reshape(len(part), -1), axis=1, count=dimensions)
                codes = (signs * np.float32(2) - np.float32(1)) / np.float32(root)
                # <code, query> / <code, vector> estimates <vector, query>, of unit vectors.
                estimate = (codes @ turned.T.astype(np.float32)) / fit[:, None]
                slack = epsilon * np.sqrt((1 - np.minimum(fit, 1) ** 2) / max(dimensions - 1, 1)) / fit
                middle = norm[:, None] ** 2 + query_norm**2 - 2 * norm[:, None] * estimate
                width = 2 * norm[:, None] * query_norm * slack[:, None]
                low, high = middle - width, middle + width
                own = ids[:, None] == query_ids
                high[own] = np.inf
                bar = _kth_by_id(ids, high, k)
                known = np.array([best.limit(q) ** 2 for q in range(len(query_ids))])
                # Rounding of the estimates in single precision must not cost a vector.
                bar = np.minimum(bar, known) + 1e-5 * (1 + query_norm**2 + norm.max(initial=0.0) ** 2)
                chosen = (low <= bar) & ~own
                for q in np.flatnonzero(chosen.any(axis=0)):
                    rows = np.flatnonzero(chosen[:, q])
                    gap = vectors[rows] - queries[q]
                    best.add(q, ids[rows], np.sqrt((gap * gap).sum(axis=1)))
        counts = [len(i) for i in best.ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(query_ids, counts)), pa.array(np.concatenate(best.ids)),
             pa.array(np.concatenate(best.scores))],
            ["query_id", "vec_id", "score"],
        )

    return run


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block: int = 2048,
    epsilon: float = 4.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose id is
    divisible by ``every``, by Euclidean distance; ties go to the smaller id."""
    spark = limit_batches(vectors.sparkSession)
    schema = "query_id long, vec_id long, score double"
    folder = f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}/nearest-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(folder)
    rows = materialise(usable(vectors, id_column, vector_column), "vectors")
    lengths = rows.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()
    for (dimensions,) in lengths:
        of_length = rows.where(F.size("vector") == dimensions)
        index, mean, turn = build_index(of_length, dimensions)
        queries = index.where(F.col("id") % every == 0).select("id", "vector")
        blocks = math.ceil(queries.count() / block)
        if blocks:
            number = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).alias("block")
            queries = queries.select("id", "vector", number).repartitionByRange("block")
            queries = materialise(queries.sortWithinPartitions("block", "id"), "queries")
        for this in range(blocks):
            some = queries.where(F.col("block") == this).collect()  # about ``block`` vectors
            if not some:
                continue
            held = spark.sparkContext.broadcast(
                (np.array([q.id for q in some]), np.array([q.vector for q in some]))
            )
            found = index.mapInArrow(_scan(held, mean, turn, k, epsilon), schema)
            found.write.mode("append").parquet(folder)
            held.destroy()
    found = spark.read.schema(schema).parquet(folder)
    # Several vectors of an id are several queries, or are found several times.
    nearest_of = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = nearest_of.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
