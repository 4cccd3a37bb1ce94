"""Exact distinct counts that roll up, from bitmaps over dense numbers.

Values get numbers without gaps, so a set of them is a bitmap of as many bits as there are
values, in blocks of 32,768. Bitmaps are kept per month; those of a quarter or a year are
their unions, so a longer period never reads the facts again, and a month that is written
anew changes only its own bitmaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.running import with_running_sums
from starloom.session import materialise


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``value, number`` of the distinct values of a one-column frame, from 1 on. With
    ``known`` numbers stay as they are, and only new values get further ones."""
    new = values.select(F.col(values.columns[0]).alias("value")).where("value is not null").distinct()
    first = 0
    if known is not None:
        new = new.join(known, "value", "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    placed = with_running_sums(new, [F.col("value")], {"number": F.lit(1).cast("long")})
    placed = placed.withColumn("number", F.col("number") + first)
    return placed if known is None else known.unionByName(placed)


def monthly_bitmaps(facts: DataFrame, key: str, day: str, numbers: DataFrame) -> DataFrame:
    """``in_month, block, n_rows, bits``: which values each month has, and its rows. Rows
    without a value are in no block. Sums and bitmaps are combined before the shuffle."""
    rows = facts.select(F.col(key).alias("value"), F.trunc(day, "month").alias("in_month"))
    # A value that many rows share meets its number once for each month.
    rows = rows.groupBy("in_month", "value").agg(F.count("*").alias("n"))
    met = rows.join(numbers, "value", "left")
    return met.groupBy("in_month", F.bitmap_bucket_number("number").alias("block")).agg(
        F.sum("n").alias("n_rows"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
    )


def distinct_by(bitmaps: DataFrame, grain: str) -> DataFrame:
    """``metric_time, n_rows, n_distinct`` per month, quarter or year."""
    if grain not in ("month", "quarter", "year"):
        raise ValueError("bitmaps are kept per month: grain must be month, quarter or year")
    period = F.trunc("in_month", grain).alias("metric_time")
    blocks = bitmaps.groupBy(period, "block").agg(
        F.sum("n_rows").alias("n_rows"), F.bitmap_or_agg("bits").alias("bits")
    )
    held = F.when(F.col("block").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    return blocks.groupBy("metric_time").agg(
        F.sum("n_rows").alias("n_rows"), F.sum(held).alias("n_distinct")
    )


def stored_bitmaps(facts: DataFrame, key: str, day: str, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The bitmaps as a written table, and the numbers of the values."""
    numbers = materialise(numbered(facts.select(key), known), "numbers")
    return materialise(monthly_bitmaps(facts, key, day, numbers), "bitmaps"), numbers
