"""Exact interpolated quantiles of a column."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.running import with_running_sums
from starloom.session import materialise


def quantiles(df: DataFrame, column: str, shares: list[float]) -> dict[float, float | None]:
    """Quantiles by linear interpolation between neighbouring rows.

    Rows are counted per value, the counts are summed up in order over value ranges, and
    each wanted position falls to the first value whose sum goes beyond it.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    walked = materialise(
        with_running_sums(counts, [F.col("value")], {"last": F.col("n")}), "value_positions"
    )
    rows = walked.agg(F.sum("n")).first()[0]
    if not rows:
        return {share: None for share in shares}
    places = sorted({f(share * (rows - 1)) for share in shares for f in (floor, ceil)})
    found = walked.agg(
        *[F.min(F.when(F.col("last") > place, F.col("value"))).alias(str(place)) for place in places]
    ).first()
    out = {}
    for share in shares:
        position = share * (rows - 1)
        left, right = found[str(floor(position))], found[str(ceil(position))]
        out[share] = left + (right - left) * (position - floor(position))
    return out
