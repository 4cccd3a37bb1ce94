"""Conformed dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import date_key, distance_band, flag, month_day_in, surrogate_key

# Calendar ends, seasons and public holidays as (month, day).
CALENDAR_FIRST, CALENDAR_LAST = "2023-01-01", "2026-12-31"
PEAK_MONTHS = [7, 8, 12]
SHOULDER_MONTHS = [6, 11, 1]
HOLIDAYS_CI = [(1, 1), (8, 7), (11, 15), (12, 25), (5, 1)]
HOLIDAYS_FR = [(1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)]

# Hub, country groups, cabin codes and rule bands.
HUB = "ABJ"
COUNTRY_GROUPS = {
    "West Africa": ["Côte d'Ivoire", "Ghana", "Senegal", "Nigeria", "Benin", "Burkina Faso", "Togo"],
    "North Africa": ["Morocco"],
    "Middle East": ["UAE"],
    "Europe": ["France"],
}
CABIN_CODES = {"Business": "J", "Premium Economy": "W", "Economy": "Y"}
RULE_BANDS = {"Basic": "restrictive", "Standard": "standard", "Flex": "flexible"}
REFERENCE_YEAR = 2026
WIDEBODY = "A330-900neo"


def days(spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST) -> DataFrame:
    """One row per day."""
    ends = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(ends).alias("date_day"))


def dim_date(spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST) -> DataFrame:
    day = F.col("date_day")
    week_day = F.dayofweek(day) - 1  # Sunday is 0
    return days(spark, first, last).select(
        "date_day",
        date_key(day).alias("date_sk"),
        F.year(day).alias("year_num"),
        F.quarter(day).alias("quarter_num"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("iso_week"),
        week_day.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        week_day.isin(0, 6).alias("is_weekend"),
        F.when(F.month(day).isin(PEAK_MONTHS), "peak")
        .when(F.month(day).isin(SHOULDER_MONTHS), "shoulder")
        .otherwise("off_peak")
        .alias("season_aviation"),
        month_day_in(day, HOLIDAYS_CI).alias("is_holiday_ci"),
        month_day_in(day, HOLIDAYS_FR).alias("is_holiday_fr"),
        F.trunc(day, "month").alias("month_start_date"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        F.trunc(day, "year").alias("year_start_date"),
    )


def dim_airport(airports: DataFrame) -> DataFrame:
    group = F.lit("Other")
    for name, countries in COUNTRY_GROUPS.items():
        group = F.when(F.col("country").isin(countries), name).otherwise(group)
    return airports.select(
        surrogate_key("airport_code").alias("airport_sk"),
        "airport_code", "airport_name", "city", "country", "timezone", "latitude", "longitude",
        flag(F.col("airport_code") == HUB).alias("is_hub"),
        group.alias("country_group"),
    )


def dim_aircraft(aircraft: DataFrame) -> DataFrame:
    return aircraft.select(
        surrogate_key("tail_number").alias("aircraft_sk"),
        "tail_number", "aircraft_type", "manufacturer", "build_year", "fleet_status",
        "seats_business", "seats_premium_eco", "seats_economy", "total_seats", "typed_capacity",
        (F.lit(REFERENCE_YEAR) - F.col("build_year")).alias("age_years"),
        flag(F.col("aircraft_type") == WIDEBODY).alias("is_widebody"),
    )


def _lookup(column: str, values: dict[str, str]):
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def dim_fare(bookings: DataFrame) -> DataFrame:
    """Distinct fare pairs seen in bookings."""
    return (
        bookings.select("fare_class", "fare_family")
        .distinct()
        .select(
            surrogate_key("fare_class", "fare_family").alias("fare_sk"),
            "fare_class",
            "fare_family",
            _lookup("fare_class", CABIN_CODES).alias("cabin_code"),
            _lookup("fare_family", RULE_BANDS).alias("fare_rule_band"),
            flag(F.col("fare_class").isin("Business", "Premium Economy")).alias("is_premium_cabin"),
        )
    )


def dim_route(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """Routes with both airport keys; the airport dimension plays two parts."""
    origin = airports.select(
        F.col("airport_code").alias("origin_airport_code"),
        F.col("airport_sk").alias("origin_airport_sk"),
    )
    destination = airports.select(
        F.col("airport_code").alias("destination_airport_code"),
        F.col("airport_sk").alias("destination_airport_sk"),
    )
    joined = routes.join(origin, "origin_airport_code", "left").join(
        destination, "destination_airport_code", "left"
    )
    return joined.select(
        surrogate_key("route_id").alias("route_sk"),
        "route_id", "origin_airport_sk", "destination_airport_sk", "origin_airport_code",
        "destination_airport_code", "route_type", "distance_km", "block_time_min",
        "route_status", "is_strategic",
        distance_band(F.col("distance_km")).alias("distance_band"),
    )


def dim_customer_current(open_versions: DataFrame, today: dt.date) -> DataFrame:
    """Latest state of each customer; age counts calendar-year steps."""
    now = F.lit(today)
    return open_versions.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "gender", "birth_date", "country", "city",
        "customer_segment", "loyalty_tier",
        F.coalesce("loyalty_tier", F.lit("non_member")).alias("loyalty_tier_safe"),
        F.col("loyalty_tier").isNotNull().alias("is_loyalty_member"),
        "signup_date", "preferred_channel",
        (F.year(now) - F.year("birth_date")).alias("age_years"),
        F.datediff(now, "signup_date").alias("tenure_days"),
    )
