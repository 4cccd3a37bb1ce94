"""Joins of tables that are stored in buckets of their key, without a shuffle.

Rows of one key lie in one bucket, so a key with very many rows would make one task slow,
and there is no shuffle that could be split. Such keys are found when a table is written,
and their rows stored apart, without buckets; a join meets them with the few rows of these
keys on the other side.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucketed:
    """A table in ``buckets`` of ``key``: rows of usual keys, rows of keys with too many
    (``hot``; null is one of them, as it meets nothing), and a row for each of these keys."""

    key: str
    buckets: int
    rows: DataFrame
    hot: DataFrame
    hot_keys: DataFrame


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, most: int = 1_000_000) -> Bucketed:
    """Store a table in buckets. There is at most one hot key for each ``most`` rows, so the
    list of them stays small enough to broadcast."""
    spark = df.sparkSession
    counted = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
    counted.where((F.col("_n") > most) | F.col("_hot").isNull()).select("_hot").write.mode("overwrite").parquet(
        f"{path}/hot_keys"
    )
    hot_keys = spark.read.schema(df.select(F.col(key).alias("_hot")).schema).parquet(f"{path}/hot_keys")
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    df.join(F.broadcast(hot_keys), is_hot, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    usual = df.join(F.broadcast(hot_keys), is_hot, "left_anti")
    name = f"bucketed_{uuid.uuid4().hex}"
    usual.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").saveAsTable(name)
    hot = spark.read.schema(df.schema).parquet(f"{path}/hot")
    return Bucketed(key, buckets, spark.table(name), hot, hot_keys)


def colocated_join(left: Bucketed, right: Bucketed, how: str = "left") -> DataFrame:
    """Join by the key both are stored by; ``right`` must have few rows for each key, such as
    the parents of a fact. The usual keys meet bucket by bucket; hot keys of the left side
    are joined with just the right rows of these keys."""
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError("the tables are not stored alike")
    if not right.hot_keys.where("_hot is not null").isEmpty():
        raise ValueError("the right side has keys with too many rows")
    if how not in ("left", "inner"):
        raise ValueError(f"{how} joins are not made here")
    key = left.key
    met = left.rows.join(right.rows.hint("merge"), key, how)
    is_hot = F.col(key) == F.col("_hot")
    few = right.rows.join(F.broadcast(left.hot_keys), is_hot, "left_semi")
    return met.unionByName(left.hot.join(few, key, how))
