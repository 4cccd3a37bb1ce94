"""Reading the inputs and casting them to their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.schemas import RENAMES, SEED_SCHEMAS, columns


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan ``{folder}/{name}.parquet`` and keep the contract's columns.

    The files' own types are kept here; ``stage`` casts them, so a file with
    wider or zoned types can be read too.
    """
    return spark.read.parquet(f"{folder}/{name}.parquet").select(
        *[column for column, _ in columns(name)]
    )


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read one lookup file, ``{folder}/{name}.csv``, with a fixed schema."""
    return spark.read.csv(f"{folder}/{name}.csv", schema=SEED_SCHEMAS[name], header=True)


def stage(df: DataFrame, source: str) -> DataFrame:
    """Cast and rename one input one-to-one, stamping the load time."""
    names = RENAMES.get(source, {})
    out = [f"cast({c} as {kind}) as {names.get(c, c)}" for c, kind in columns(source)]
    if source == "customer_feedback":
        out.append("lower(cast(raw_text as string)) as normalised_text")
    return df.selectExpr(*out, "current_timestamp() as _loaded_at")
