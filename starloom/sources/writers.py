"""Writing tables: in one piece, by month, and in buckets of a key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition column of tables written by month: the first day of the month of a row.
MONTH = "in_month"

# Half of a table is hashes in hex: this codec halves them, the default one does not.
CODEC = "zstd"


def write_table(df: DataFrame, path: str, day: str | None = None) -> DataFrame:
    """Replace the parquet table at ``path`` and read it back.

    With ``day`` the rows of each file are sorted by that column. The sort is local to
    a task, so nothing is shuffled, and a date range later skips row groups and pages
    by their min/max statistics.
    """
    if day:
        df = df.sortWithinPartitions(day)
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The columns of a table, as they follow from each row alone.
Columns = Callable[[], list[str | Column]]


def _monthly(df: DataFrame, day: str, columns: Columns | None, deal: bool) -> DataFrame:
    """Rows dealt to writers by month, sorted by day in each. ``columns`` are made after
    that, so that what they add does not travel.

    ``rebalance`` deals by month and then evens out by size: small months share a task, and
    a month above the advisory partition size, a hot one too, is split among as many tasks
    as it holds such sizes. So files are few, and none grows with the data.

    Without ``deal`` the tasks that made the rows write them, and nothing is shuffled. Each
    writes a file a month, so there are as many files a month as tasks: for rows that a join
    has spread evenly over tasks of the advisory size.
    """
    placed = df.withColumn(MONTH, F.trunc(day, "month"))
    if deal:
        placed = placed.hint("rebalance", F.col(MONTH))
    placed = placed.sortWithinPartitions(MONTH, day)
    return placed if columns is None else placed.select(*columns(), MONTH)


def write_by_month(
    df: DataFrame, path: str, day: str, columns: Columns | None = None, deal: bool = True
) -> DataFrame:
    """Replace the table at ``path``, a folder for each month of ``day``, and read it back.
    ``columns`` makes the rows of the table from those of ``df``.

    The table read back also has the partition column ``in_month``; rows without a day are
    in a folder of their own, and have a null there.
    """
    rows = _monthly(df, day, columns, deal)
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path, compression=CODEC)
    return read_by_month(df.sparkSession, path, rows.schema)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    columns = [f for f in schema.fields if f.name != MONTH]
    return spark.read.schema(T.StructType([*columns, T.StructField(MONTH, T.DateType())])).parquet(path)


def in_months(day: str, months: list[dt.date]) -> Column:
    """Rows whose day lies in one of the months, as ranges, so that a scan can skip files."""
    ranges = []
    for month in sorted({m.replace(day=1) for m in months}):
        after = (month + dt.timedelta(days=31)).replace(day=1)
        ranges.append((F.col(day) >= F.lit(month)) & (F.col(day) < F.lit(after)))
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def replace_months(
    df: DataFrame, path: str, day: str, months: list[dt.date], columns: Columns | None = None,
    deal: bool = True,
) -> None:
    """Write the rows of some months anew; the folders of all others are not touched.

    A month that has no rows any more loses its folder. ``df`` must not read these months
    from ``path``.
    """
    spark = df.sparkSession
    folders = {f"{path}/{MONTH}={m.replace(day=1)}" for m in months}
    before = {folder: _files(spark, folder) for folder in folders}
    rows = _monthly(df.where(in_months(day, months)), day, columns, deal)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
    writer.parquet(path, compression=CODEC)
    for folder, old in before.items():
        if old & _files(spark, folder):  # nothing was written there
            place, system = _place(spark, folder)
            system.delete(place, True)


def _place(spark: SparkSession, folder: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> set[str]:
    place, system = _place(spark, folder)
    if not system.exists(place):
        return set()
    return {status.getPath().getName() for status in system.listStatus(place)}
