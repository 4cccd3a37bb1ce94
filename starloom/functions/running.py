"""Running sums over a whole table, in one way for any size.

The table is dealt into ranges of its order, every range is summed on its own, and the
sums of the ranges before are added. No window runs over all rows: the only one without
partitions has a row per range, as many as the session's shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialise


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add the sum of each expression over all rows up to and including the row.

    ``order`` should tell rows apart: rows that tie stay in one range, and get their sums
    in no fixed order. Expressions must give longs, decimals or doubles, and may only name
    columns of ``df``, which is written to the shared folder on the way.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    placed = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range").agg(
        *[F.sum(value).alias(f"_total{i}") for i, value in enumerate(sums.values())]
    )
    offsets = totals.select(
        "_range",
        *[
            F.coalesce(F.sum(f"_total{i}").over(before), F.lit(0)).alias(f"_had{i}")
            for i in range(len(sums))
        ],
    )
    upto = Window.partitionBy("_range").orderBy(*order)
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.join(F.broadcast(offsets), "_range").select(  # a row per range
        *columns,
        *[
            (F.sum(value).over(upto) + F.col(f"_had{i}")).alias(name)
            for i, (name, value) in enumerate(sums.items())
        ],
    )
