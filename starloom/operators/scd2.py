"""History tables: one row per version of a record, and joins to the version in force."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise

CHECKED = ("loyalty_tier", "customer_segment", "preferred_channel")


def _version_id(key: str, at: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.date_format(at, "yyyy-MM-dd HH:mm:ss")))


def first_snapshot(incoming: DataFrame, key: str, at: dt.datetime) -> DataFrame:
    """A history with one open version per record."""
    now = F.lit(at).cast("timestamp_ntz")
    return incoming.select(
        "*",
        _version_id(key, now).alias("dbt_scd_id"),
        now.alias("dbt_updated_at"),
        now.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def merge_snapshot(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    at: dt.datetime,
    checked: tuple[str, ...] = CHECKED,
) -> DataFrame:
    """The history after a further snapshot.

    A record gets a new version when a checked column differs (nulls compare as
    values); the open version is then closed. Other columns do not matter, and a
    record missing from ``incoming`` stays open. Running the same snapshot again
    changes nothing. Closed versions are passed through without a shuffle. Write the
    result to a new path: it reads the old one. ``HistoryStore`` does not pass them
    through at all.
    """
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    return closed.unionByName(changed_versions(current(history), incoming, key, at, checked))


def changed_versions(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str,
    at: dt.datetime,
    checked: tuple[str, ...] = CHECKED,
) -> DataFrame:
    """The open versions after a further snapshot, and those that it closes."""
    columns = incoming.columns
    fresh = incoming.select(F.struct(*columns).alias("_new"), F.col(key).alias("_key"))
    paired = open_rows.select(F.struct(*open_rows.columns).alias("_old"), F.col(key).alias("_key")).join(
        fresh, "_key", "full"
    )
    same = F.lit(True)
    for column in checked:
        same = same & F.col(f"_old.{column}").eqNullSafe(F.col(f"_new.{column}"))
    changed = F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~same
    added = F.col("_old").isNull()
    now = F.lit(at).cast("timestamp_ntz")
    version = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns],
        _version_id("_key", now).alias("dbt_scd_id"),
        now.alias("dbt_updated_at"),
        now.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )
    kept = F.struct(
        *[F.col(f"_old.{c}").alias(c) for c in columns],
        F.col("_old.dbt_scd_id").alias("dbt_scd_id"),
        F.when(changed, now).otherwise(F.col("_old.dbt_updated_at")).alias("dbt_updated_at"),
        F.col("_old.dbt_valid_from").alias("dbt_valid_from"),
        F.when(changed, now).alias("dbt_valid_to"),
    )
    rows = (
        F.when(changed, F.array(kept, version)).when(added, F.array(version)).otherwise(F.array(kept))
    )
    return paired.select(F.explode(rows).alias("row")).select("row.*")


def current(history: DataFrame) -> DataFrame:
    """The open versions."""
    return history.where(F.col("dbt_valid_to").isNull())


def version_in_force(
    facts: DataFrame, history: DataFrame, key: str, day: str, columns: list[str], most: int = 64
) -> DataFrame:
    """Left join to the version whose days hold ``day``: from its start up to, but not
    including, its end. Joined columns get the prefix ``version_``. The versions of a record
    must not overlap.

    A row meets one row of the other side, never each version of its record: versions are
    gathered into one row for each record, or, for records with more than ``most`` of them,
    into one row for each of its months. A month has no more versions than days, as one that
    ends on the day it starts is never in force.
    """
    payload = F.struct("_from", "_to", *[f"version_{c}" for c in columns])
    versions = history.select(
        F.col(key).alias("_key"),
        F.col("dbt_valid_from").cast("date").alias("_from"),
        F.col("dbt_valid_to").cast("date").alias("_to"),
        *[F.col(c).alias(f"version_{c}") for c in columns],
    ).where("_key is not null and (_to is null or _from < _to)")
    gathered = F.collect_list(payload).alias("_versions")
    many = versions.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_key")
    many = materialise(many, "long_histories")
    if many.isEmpty():
        joined = facts.join(versions.groupBy("_key").agg(gathered), F.col(key) == F.col("_key"), "left")
        held = F.col("_versions")
    else:
        few = versions.join(many, "_key", "left_anti").groupBy("_key").agg(gathered)
        long = versions.join(many, "_key", "left_semi")
        # Later rows look into the last month that a version starts or ends in: what is
        # open there stays in force.
        last = F.trunc(long.agg(F.max(F.greatest("_from", "_to"))).scalar(), "month")
        end = F.least(F.trunc(F.date_sub(F.coalesce("_to", last), 1), "month"), last)
        months = F.sequence(F.trunc("_from", "month"), F.when(F.col("_to").isNull(), last).otherwise(end), F.expr("interval 1 month"))
        by_month = (
            long.withColumn("_month", F.explode(months))
            .groupBy(F.col("_key").alias("_long_key"), "_month")
            .agg(F.collect_list(payload).alias("_of_month"))
        )
        joined = facts.join(few, F.col(key) == F.col("_key"), "left").join(
            by_month,
            (F.col(key) == F.col("_long_key")) & (F.least(F.trunc(day, "month"), last) == F.col("_month")),
            "left",
        )
        held = F.coalesce("_versions", "_of_month")
    here = F.filter(
        held, lambda v: (v["_from"] <= F.col(day)) & (v["_to"].isNull() | (F.col(day) < v["_to"]))
    )
    found = joined.withColumn("_version", F.get(here, F.lit(0)))
    return found.select(*facts.columns, *[f"_version.version_{c}" for c in columns])
