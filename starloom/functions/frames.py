"""Small helpers over frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames by column name, paired up so that each plan is analysed
    only log(n) times."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def repeats(df: DataFrame, key: str) -> bool:
    """Whether a value of the key is there more than once; null is none. Only keys travel."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return not counted.where("_n > 1").isEmpty()


def asked(tables: Mapping[str, DataFrame], name: str, *texts: str) -> DataFrame:
    """A table for a question that names its columns in ``texts``. Tables that can leave
    columns out (``AskedTables``) make no others."""
    ask = getattr(tables, "asked", None)
    return ask(name, " ".join(texts)) if ask else tables[name]
