"""Tables by month and in buckets, histories in files, and what their plans read."""

import datetime as dt
import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators import reports, scd2
from starloom.operators.colocated import colocated_join, write_bucketed
from starloom.plans.history import HistoryStore
from starloom.plans.register import marts, warehouse
from starloom.plans.warehouse import FACT_COLUMNS, FACT_DAYS, SPREAD_FACTS, TablesOnDemand, current_version
from starloom.session import shared_folder
from starloom.sources.writers import MONTH, _monthly, replace_months, write_by_month

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def days(spark, rows):
    return spark.createDataFrame([(d, i) for i, d in enumerate(rows)], "day date, i int")


def test_months_are_replaced_alone(spark, tmp_path):
    first = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 15, 28)] + [None]
    path = str(tmp_path / "fact")
    stored = write_by_month(days(spark, first), path, "day")
    assert stored.count() == 10 and stored.where(f"{MONTH} is null").count() == 1
    before = files(path)
    new = days(spark, [dt.date(2024, 2, 9), dt.date(2024, 1, 30), dt.date(2024, 3, 3)])
    replace_months(new, path, "day", [dt.date(2024, 2, 17)])
    after = files(path)
    assert {k: v for k, v in before.items() if f"{MONTH}=2024-02-01" not in str(k)}.items() <= after.items()
    got = spark.read.schema(stored.schema).parquet(path).where("day is not null")
    assert sorted(r.day for r in got.collect() if r.day.month == 2) == [dt.date(2024, 2, 9)]
    assert got.count() == 7
    # A month without rows goes; others stay.
    replace_months(days(spark, []), path, "day", [dt.date(2024, 3, 1), dt.date(2025, 5, 1)])
    assert {r[MONTH].month for r in spark.read.schema(stored.schema).parquet(path).where("day is not null").collect()} == {1, 2}


def test_a_hot_month_has_several_writers(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 < 2, F.lit(dt.date(2024, 6, 3)))
        .otherwise(F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 800).cast("int"))).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = tmp_path / "fact"
    assert write_by_month(rows.repartition(40), str(path), "day").count() == 400_000
    count = {p.name: len(list(p.glob("*.parquet"))) for p in path.iterdir() if p.is_dir()}
    # Of 40 tasks, no more write a month than its part of the shuffle was split into.
    assert 2 <= count[f"{MONTH}=2024-06-01"]
    assert max(count.values()) <= 12


def test_pages_read_only_their_months(spark):
    tables = marts(warehouse(spark, FOLDER))
    for fact in FACT_DAYS:
        page = reports.page(fact, tables, dt.date(2024, 3, 10), dt.date(2024, 9, 20), ["R001"])
        text = plan(page)
        assert "PartitionFilters: [isnotnull(in_month" in text
        assert "in_month#" in text and "2024-03-01" in text
        read = page.collect()
        assert {r.month for r in read} <= {dt.date(2024, m, 1) for m in range(3, 10)}
    chosen = tables["dim_date"].where("season_aviation = 'peak' and year_num = 2024")
    assert "dynamicpruning" in plan(reports.page("fct_bookings", tables, days=chosen))


def test_a_month_of_the_current_version_is_rebuilt(spark, tmp_path):
    folder = str(tmp_path / "marts")
    w = warehouse(spark, FOLDER)
    w.build(folder)
    path = f"{current_version(spark, folder)}/fct_flights"
    before = files(path)
    warehouse(spark, FOLDER).replace_months(folder, [dt.date(2024, 5, 1)], ["fct_flights"])
    after = files(path)
    changed = {k for k in before if before[k] != after.get(k)} | (set(after) - set(before))
    assert changed and all(f"{MONTH}=2024-05-01" in str(k) for k in changed)


def test_buckets_join_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(3_000).select(F.col("id"), (F.col("id") % 700).alias("k"))
        left = left.unionByName(spark.range(500).select(F.col("id"), F.lit(13).cast("long").alias("k")))
        left = left.unionByName(spark.range(20).select(F.col("id"), F.lit(None).cast("long").alias("k")))
        right = spark.range(600).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        a = write_bucketed(left, str(tmp_path / "a"), "k", 8, most=100)
        b = write_bucketed(right, str(tmp_path / "b"), "k", 8, most=100)
        assert sorted(r[0] for r in a.hot_keys.collect() if r[0] is not None) == [13]
        assert a.hot.count() == 525
        for how in ("left", "inner"):
            joined = colocated_join(a, b, how)
            text = plan(joined)
            assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
            assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right, "k", how).select("k", "id", "v").collect()))
        with pytest.raises(ValueError, match="too many"):
            colocated_join(b, a)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


PEOPLE = "customer_id string, loyalty_tier string, customer_segment string, preferred_channel string, city string"


def test_snapshots_leave_closed_files_alone(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), "customer_id")
    merged = None
    seen = {}
    for n, tiers in enumerate(["abc", "aXc", "aXYZ", "aXYZ", "bXYW"]):
        at = dt.datetime(2025, 1, 1 + n)
        now = spark.createDataFrame([(str(i), t, "s", "c", f"{n}") for i, t in enumerate(tiers)], PEOPLE)
        store.take(now, at)
        store.take(now.where("false"), at)  # taken already
        merged = scd2.first_snapshot(now, "customer_id", at) if merged is None else scd2.merge_snapshot(merged, now, "customer_id", at)
        names = merged.columns
        assert sorted(map(str, store.read().select(names).collect())) == sorted(map(str, merged.collect()))
        current = files(tmp_path / "h" / "versions")
        assert seen.items() <= current.items()
        seen = current
    assert store.open_rows().count() == 4 and store.read().count() == 8
    with pytest.raises(ValueError, match="later"):
        store.take(merged.where("false"), dt.datetime(2024, 1, 1))
    # What an unfinished snapshot left behind is not read.
    unfinished = tmp_path / "h" / "versions" / "snapshot=20250103T120000"
    merged.withColumn("state", F.lit("closed")).write.partitionBy("state").parquet(str(unfinished))
    assert store.read().count() == 8


def test_thousands_of_versions_of_one_customer(spark):
    first = dt.date(2018, 1, 1)
    versions, facts = [], []
    for i in range(2_500):  # a version a day, several on some days
        start = first + dt.timedelta(days=i - i % 7 % 2)
        end = None if i == 2_499 else first + dt.timedelta(days=i + 1 - (i + 1) % 7 % 2)
        versions.append(("hot", f"v{i}", start, end))
    versions += [("few", "a", first, first + dt.timedelta(days=9)), ("few", "b", first + dt.timedelta(days=9), None)]
    versions += [("gap", "c", first, first + dt.timedelta(days=1)), (None, "n", first, None)]
    for key in ("hot", "few", "gap", "none", None):
        facts += [(key, first + dt.timedelta(days=d)) for d in range(-40, 3_000, 13)]
    facts += [("hot", None), ("few", None)]
    history = spark.createDataFrame(versions, "k string, v string, a date, b date").selectExpr(
        "k", "v", "cast(a as timestamp_ntz) as dbt_valid_from", "cast(b as timestamp_ntz) as dbt_valid_to"
    )
    rows = spark.createDataFrame(facts, "k string, day date")
    expected = []
    for key, day in facts:
        hit = [v for k, v, a, b in versions if k == key and k is not None and day and a <= day and (b is None or day < b)]
        assert len(hit) <= 1
        expected.append((key, day, hit[0] if hit else None))
    for most in (1, 64, 10_000):
        found = scd2.version_in_force(rows, history, "k", "day", ["v"], most)
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_marts_are_built_as_far_as_they_are_asked_for(spark):
    w = warehouse(spark, FOLDER)
    tables = TablesOnDemand(w, f"{shared_folder(spark)}/{uuid.uuid4().hex}", set())
    assert tables["int_route_monthly_perf"].count() > 0
    assert tables.done == {"int_route_monthly_perf", "int_flight_full"}
    # Another reader of the same version finds them written.
    again = TablesOnDemand(warehouse(spark, FOLDER), tables.path, tables.done)
    before = files(tables.path)
    assert again["int_route_monthly_perf"].count() == tables["int_route_monthly_perf"].count()
    assert files(tables.path) == before
    with pytest.raises(KeyError):
        tables["no_such_table"]


@pytest.mark.parametrize("fact", list(FACT_DAYS))
def test_written_facts_hold_the_rows_of_lazy_ones(spark, tmp_path, fact):
    w = warehouse(spark, FOLDER)
    day, path = FACT_DAYS[fact], str(tmp_path / fact)
    lazy = w[fact]
    stored = write_by_month(w.rows(fact), path, day, FACT_COLUMNS[fact], fact not in SPREAD_FACTS)
    assert stored.columns == [*lazy.columns, MONTH]
    assert stored.drop(MONTH).exceptAll(lazy).isEmpty() and lazy.exceptAll(stored.drop(MONTH)).isEmpty()


def test_keys_in_hex_are_made_after_the_last_shuffle(spark):
    w = warehouse(spark, FOLDER)
    for fact, day in FACT_DAYS.items():
        for deal in (True, False):
            rows = _monthly(w.rows(fact), day, FACT_COLUMNS[fact], deal)
            text = rows._jdf.queryExecution().optimizedPlan().toString()
            assert ("RebalancePartitions" in text) == deal
            below = text.split("RebalancePartitions")[1] if deal else ""
            made = f"AS {rows.columns[0]}#"
            assert made in text and made not in below
    text = w["fct_ancillary_offers"]._jdf.queryExecution().optimizedPlan().toString()
    # Offers are only joined by booking: the first join is theirs, customers meet bookings below.
    assert "booking_id" in next(line for line in text.splitlines() if "Join" in line)
