import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions.columns import NULL_KEY_PART, calendar_key, surrogate_key
from starloom.operators import dimensions, facts, scd2

T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 6, 9))
PEOPLE = (
    "customer_id string, city string, customer_segment string, loyalty_tier string, preferred_channel string"
)


def test_surrogate_key(frame):
    import hashlib

    df = frame([("a", None)], "x string, y string")
    row = df.select(surrogate_key("x").alias("one"), surrogate_key("x", "y").alias("two")).first()
    assert row.one == hashlib.md5(b"a").hexdigest()
    assert row.two == hashlib.md5(f"a-{NULL_KEY_PART}".encode()).hexdigest()


def test_calendar(spark):
    df = dimensions.dim_date(spark)
    assert df.count() == 1461
    rows = {r.date_day: r for r in df.where("month_num in (1, 5, 8, 12)").collect()}
    new_year = rows[dt.date(2023, 1, 1)]
    assert (new_year.date_sk, new_year.day_of_week, new_year.iso_week) == (20230101, 0, 52)
    assert new_year.is_weekend and new_year.is_holiday_ci and new_year.is_holiday_fr
    assert (new_year.season_aviation, new_year.month_name, new_year.day_name) == ("shoulder", "January", "Sunday")
    assert rows[dt.date(2024, 8, 7)].is_holiday_ci and not rows[dt.date(2024, 8, 7)].is_holiday_fr
    assert rows[dt.date(2024, 5, 8)].is_holiday_fr and not rows[dt.date(2024, 5, 8)].is_holiday_ci
    assert rows[dt.date(2025, 12, 31)].season_aviation == "peak"
    assert rows[dt.date(2025, 5, 31)].quarter_start_date == dt.date(2025, 4, 1)


def test_calendar_key_equals_the_lookup_join(spark, frame):
    days = [(dt.date(2022, 12, 31),), (dt.date(2023, 1, 1),), (dt.date(2026, 12, 31),), (dt.date(2027, 1, 1),), (None,)]
    df = frame(days, "d date")
    joined = df.join(dimensions.dim_date(spark), F.col("d") == F.col("date_day"), "left")
    made = calendar_key(F.col("d"), dimensions.CALENDAR_FIRST, dimensions.CALENDAR_LAST)
    assert joined.where(~F.col("date_sk").eqNullSafe(made)).count() == 0


@pytest.fixture(scope="module")
def history(spark):
    first = [
        ("same", "X", "Budget", "Gold", "Web"),
        ("moved", "X", "Budget", None, "Web"),
        ("city", "X", "Budget", "Gold", "Web"),
        ("gone", "X", "Budget", "Gold", "Web"),
    ]
    second = [
        ("same", "X", "Budget", "Gold", "Web"),
        ("moved", "X", "Budget", "Gold", "Web"),  # null to Gold
        ("city", "Y", "Budget", "Gold", "Web"),  # not a checked column
        ("new", "X", "Premium", None, "Web"),
    ]
    start = scd2.first_snapshot(spark.createDataFrame(first, PEOPLE), "customer_id", T1)
    incoming = spark.createDataFrame(second, PEOPLE)
    return scd2.merge_snapshot(start, incoming, "customer_id", T2), incoming


def versions(df):
    return sorted(
        (r.customer_id, r.city, r.loyalty_tier or "", r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()
    )


def test_snapshot_versions(history):
    merged, _ = history
    assert versions(merged) == [
        ("city", "X", "Gold", T1, None),
        ("gone", "X", "Gold", T1, None),
        ("moved", "X", "", T1, T2),
        ("moved", "X", "Gold", T2, None),
        ("new", "X", "", T2, None),
        ("same", "X", "Gold", T1, None),
    ]
    assert merged.select("dbt_scd_id").distinct().count() == 6


def test_snapshot_again_changes_nothing(history):
    merged, incoming = history
    again = scd2.merge_snapshot(merged, incoming, "customer_id", T3)
    assert versions(again) == versions(merged)


def test_version_in_force_is_half_open(history, frame):
    merged, _ = history
    days = [("before", dt.date(2023, 12, 31)), ("start", dt.date(2024, 1, 1)),
            ("last", dt.date(2024, 5, 31)), ("turn", dt.date(2024, 6, 1))]
    df = frame([(n, "moved", d) for n, d in days], "n string, customer_id string, day date")
    found = scd2.version_in_force(df, merged, "customer_id", "day", ["loyalty_tier", "dbt_scd_id"])
    got = {r.n: (r.version_dbt_scd_id is not None, r.version_loyalty_tier) for r in found.collect()}
    assert got == {"before": (False, None), "start": (True, None), "last": (True, None), "turn": (True, "Gold")}


def test_age_counts_calendar_years(frame):
    people = frame(
        [("a", dt.date(2000, 12, 31), dt.date(2000, 12, 31), None)],
        "customer_id string, birth_date date, signup_date date, loyalty_tier string",
    )
    for c in ("first_name", "last_name", "gender", "country", "city", "customer_segment", "preferred_channel"):
        people = people.withColumn(c, F.lit("x"))
    row = dimensions.dim_customer_current(people, dt.date(2001, 1, 1)).first()
    assert (row.age_years, row.tenure_days, row.loyalty_tier_safe, row.is_loyalty_member) == (1, 1, "non_member", False)


def test_booking_falls_back_to_the_current_customer(history, frame, spark):
    merged, _ = history
    now = scd2.current(merged)
    sold = frame(
        [("B1", "moved", dt.date(2023, 1, 1), "Economy", None), ("B2", "moved", dt.date(2024, 7, 1), "Business", "Flex")],
        "booking_id string, customer_id string, booking_date date, fare_class string, fare_family string",
    )
    sold = sold.selectExpr(
        "*", "'F1' as flight_id", "'Web' as booking_channel", "'Flown' as booking_status",
        "cast(1 as decimal(10,2)) as ticket_price_usd", "cast(2 as decimal(10,2)) as ancillary_revenue_usd",
        "1 as bags_count", "1 as seat_selection_flag",
    )
    routes = spark.sql("select 'R1' as route_id, 'sk' as route_sk")
    legs = spark.sql(
        "select 'F1' as flight_id, 'R9' as route_id, 'T1' as tail_number, 'A320' as aircraft_type, date '2024-01-02' as flight_date"
    )
    rows = {r.booking_id: r for r in facts.fct_bookings(sold, merged, now, facts.flight_keys(legs, routes)).collect()}
    assert rows["B1"].loyalty_tier_at_booking == "Gold"
    assert rows["B1"].fare_sk is None and rows["B1"].is_premium_cabin is None
    assert rows["B2"].is_premium_cabin
    # No version still gives a key, the same for all such rows.
    assert rows["B1"].customer_version_sk != rows["B2"].customer_version_sk
    assert rows["B1"].customer_version_sk is not None
    # The route is unknown, so nothing of the leg's route part shows.
    assert rows["B2"].route_id is None and rows["B2"].tail_number is None
    assert rows["B2"].flight_date_sk == 20240102
