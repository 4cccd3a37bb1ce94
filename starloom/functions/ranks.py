"""Ranks over a whole table, in one way for any size.

``percent_rank`` needs the number of rows before a value: rows are counted per value, the
counts are summed up in order over value ranges, and meet the rows again by value. ``ntile``
needs a row's position: rows are ordered by value and the hash of their key, which also
breaks ties, and numbered range by range. Only the key and the ranked column travel; a value
that many rows share is one count, or rows spread by their hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.running import with_running_sums
from starloom.session import materialise


@dataclass(frozen=True)
class Rank:
    """One rank column to add; nulls of ``column`` come last in either direction."""

    name: str
    column: str
    kind: str = "percent_rank"  # or "ntile"
    descending: bool = False
    tiles: int = 5

    def order(self) -> Column:
        column = F.col(self.column)
        return column.desc_nulls_last() if self.descending else column.asc_nulls_last()


def add_ranks(df: DataFrame, key: str, ranks: list[Rank]) -> DataFrame:
    """Add whole-table ranks to ``df``, whose ``key`` is unique.

    ``df`` is read several times, so pass a written table.
    """
    counts: dict[str, DataFrame] = {}
    for column in {rank.column for rank in ranks}:
        grouped = df.groupBy(column).agg(F.count("*").alias("_n"))
        counts[column] = materialise(grouped, "value_counts")
    rows = next(iter(counts.values())).agg(F.sum("_n")).first()[0] or 0
    ranked = df
    for rank in ranks:
        if rank.kind == "ntile":
            ranked = ranked.join(_tiles(df, key, rank, rows), key)
        else:
            ranked = _with_share(ranked, counts[rank.column], rank, rows)
    return ranked.select(*[F.col(c) for c in df.columns], *[rank.name for rank in ranks])


def _tiles(df: DataFrame, key: str, rank: Rank, rows: int) -> DataFrame:
    """The tile of every key."""
    numbered = with_running_sums(
        df.select(key, rank.column),
        [rank.order(), F.md5(F.col(key).cast("string")), F.col(key)],
        {"_position": F.lit(1).cast("long")},
    )
    return numbered.select(key, _tile(F.col("_position"), rows, rank.tiles).alias(rank.name))


def _with_share(df: DataFrame, counts: DataFrame, rank: Rank, rows: int) -> DataFrame:
    """Rows with their percent rank, joined by value."""
    upto = with_running_sums(counts, [rank.order()], {"_upto": F.col("_n")})
    share = F.lit(0.0) if rows <= 1 else (F.col("_upto") - F.col("_n")) / F.lit(float(rows - 1))
    values = upto.select(F.col(rank.column).alias("_value"), share.alias(rank.name))
    return df.join(values, F.col(rank.column).eqNullSafe(F.col("_value"))).drop("_value")


def _tile(position: Column, rows: int, tiles: int) -> Column:
    """Tile of a 1-based position; the first tiles take the remainder."""
    size, longer = divmod(rows, tiles)
    head = longer * (size + 1)
    return (
        F.when(position <= head, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(F.floor((position - 1 - head) / max(size, 1)) + longer + 1)
        .cast("int")
    )
