"""Flight and route aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import month_of, ratio, ratio_of_positive

FLOWN = "Flown"
CANCELLED = "Cancelled"
MONEY_SUM = "decimal(38,2)"


def passengers(bookings: DataFrame) -> DataFrame:
    """Flown bookings and distinct customers per flight."""
    return (
        bookings.where(F.col("booking_status") == FLOWN)
        .groupBy("flight_id")
        .agg(F.count("*").alias("pax_flown"), F.countDistinct("customer_id").alias("unique_pax"))
    )


def _revenue_sums() -> list:
    ticket, extra = F.col("ticket_price_usd"), F.col("ancillary_revenue_usd")
    return [
        F.sum(ticket).cast(MONEY_SUM).alias("ticket_revenue_usd"),
        F.sum(extra).cast(MONEY_SUM).alias("ancillary_revenue_usd"),
        F.sum(ticket + extra).cast(MONEY_SUM).alias("total_revenue_usd"),
    ]


def revenue(bookings: DataFrame) -> DataFrame:
    """Ticket, ancillary and total revenue of flown bookings per flight."""
    return (
        bookings.where(F.col("booking_status") == FLOWN).groupBy("flight_id").agg(*_revenue_sums())
    )


def on_time(status, delay, minutes: int = 15):
    """Null for a cancelled flight; false where the delay is unknown."""
    return F.when(status == CANCELLED, F.lit(None)).otherwise(
        F.coalesce(delay <= minutes, F.lit(False))
    )


def flight_full(
    flights: DataFrame,
    routes: DataFrame,
    costs: DataFrame,
    bookings: DataFrame,
    disruptions: DataFrame,
    weather: DataFrame,
) -> DataFrame:
    """One row per flight with passengers, money, disruption and origin weather.

    Bookings are aggregated in one pass before the join. The four sides keyed by
    flight are joined first and share one partitioning; the lookups follow.
    """
    sold = (
        bookings.where(F.col("booking_status") == FLOWN)
        .groupBy("flight_id")
        .agg(F.count("*").alias("pax_flown"), *_revenue_sums())
    )
    paid = costs.select(
        "flight_id", "fuel_cost_usd", "crew_cost_usd", "airport_fees_usd",
        "maintenance_alloc_usd", "irops_penalty_usd", "total_operating_cost_usd",
    )
    hit = disruptions.select(
        "flight_id",
        "disruption_type",
        F.col("severity").alias("disruption_severity"),
        F.col("duration_min").alias("disruption_duration_min"),
        "root_cause_text",
    )
    where = routes.select(
        "route_id", "origin_airport_code", "destination_airport_code", "route_type", "distance_km"
    )
    sky = weather.select(
        F.col("airport_code").alias("origin_airport_code"),
        F.col("weather_date").alias("flight_date"),
        F.col("severity_flag").alias("origin_weather_severity"),
    )
    joined = (
        flights.join(sold, "flight_id", "left")
        .join(paid, "flight_id", "left")
        .join(hit, "flight_id", "left")
        .join(where, "route_id", "left")
        .join(sky, ["origin_airport_code", "flight_date"], "left")
    )
    zero = F.lit(0).cast(MONEY_SUM)
    income = F.coalesce("total_revenue_usd", zero)
    margin = income - F.coalesce("total_operating_cost_usd", F.lit(0).cast("decimal(10,2)"))
    pax = F.coalesce("pax_flown", F.lit(0))
    return joined.select(
        "flight_id", "flight_number", "route_id", "origin_airport_code",
        "destination_airport_code", "route_type", "distance_km", "tail_number",
        "aircraft_type", "flight_date", "scheduled_departure_at", "actual_departure_at",
        "scheduled_arrival_at", "actual_arrival_at", "seat_capacity", "flight_status",
        "delay_min",
        pax.alias("pax_count"),
        F.coalesce("ticket_revenue_usd", zero).alias("ticket_revenue_usd"),
        F.coalesce("ancillary_revenue_usd", zero).alias("ancillary_revenue_usd"),
        income.alias("total_revenue_usd"),
        "fuel_cost_usd", "crew_cost_usd", "airport_fees_usd", "maintenance_alloc_usd",
        "irops_penalty_usd", "total_operating_cost_usd",
        margin.cast(MONEY_SUM).alias("flight_margin_usd"),
        ratio_of_positive(margin, income).alias("flight_margin_pct"),
        ratio_of_positive(pax, F.col("seat_capacity")).alias("load_factor"),
        on_time(F.col("flight_status"), F.col("delay_min")).alias("is_on_time_15"),
        "disruption_type", "disruption_severity", "disruption_duration_min",
        "root_cause_text", "origin_weather_severity",
    )


def route_monthly(flight_rows: DataFrame) -> DataFrame:
    """Fourteen measures per route and month."""
    cancelled = F.col("flight_status") == CANCELLED
    sums = flight_rows.groupBy("route_id", month_of(F.col("flight_date")).alias("period_month")).agg(
        F.count("*").alias("flights_scheduled"),
        F.count_if(cancelled).alias("flights_cancelled"),
        F.count_if(~cancelled).alias("flights_operated"),
        F.sum("pax_count").alias("total_pax"),
        F.sum("seat_capacity").alias("total_seat_capacity"),
        F.sum("total_revenue_usd").cast(MONEY_SUM).alias("revenue_usd"),
        F.sum("total_operating_cost_usd").cast(MONEY_SUM).alias("operating_cost_usd"),
        F.count_if("is_on_time_15").alias("_on_time"),
    )
    margin = F.col("revenue_usd") - F.col("operating_cost_usd")
    return sums.select(
        "*",
        margin.cast(MONEY_SUM).alias("margin_usd"),
        ratio_of_positive(margin, F.col("revenue_usd")).alias("margin_pct"),
        ratio_of_positive(F.col("total_pax"), F.col("total_seat_capacity")).alias("load_factor"),
        ratio(F.col("flights_cancelled"), F.col("flights_scheduled")).alias("cancellation_rate"),
        ratio(F.col("_on_time"), F.col("flights_operated")).alias("otp15_rate"),
    ).drop("_on_time")
