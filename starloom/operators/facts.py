"""Fact tables.

Calendar and fare keys are computed in place: the calendar is complete between its
ends and the fare dimension is drawn from bookings itself, so a lookup join could
only return the same value. Keys of customers and flights are computed in place where the
join found one, as they are hashes of the id that it joins by.

Each fact is made in two steps: ``*_rows`` joins, ``*_columns`` adds what follows from a row
alone. Hashes do not compress, so a table is dealt out to its writers between the steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import calendar_key, flag, surrogate_key
from starloom.operators.dimensions import CALENDAR_FIRST, CALENDAR_LAST
from starloom.operators.flights import CANCELLED, FLOWN
from starloom.operators.scd2 import version_in_force

Columns = list[str | Column]


def _date_key(day: Column) -> Column:
    return calendar_key(day, CALENDAR_FIRST, CALENDAR_LAST)


def _fare_key() -> Column:
    both = F.col("fare_class").isNotNull() & F.col("fare_family").isNotNull()
    return F.when(both, surrogate_key("fare_class", "fare_family"))


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def fct_flights(
    flight_rows: DataFrame, routes: DataFrame, aircraft: DataFrame, airports: DataFrame
) -> DataFrame:
    """One row per flight with its dimension keys."""
    return flight_joins(flight_rows, routes, aircraft, airports).select(*flight_columns())


def flight_joins(
    flight_rows: DataFrame, routes: DataFrame, aircraft: DataFrame, airports: DataFrame
) -> DataFrame:
    origin = _renamed(airports, origin_airport_sk="airport_sk", origin_airport_code="airport_code")
    target = _renamed(
        airports, destination_airport_sk="airport_sk", destination_airport_code="airport_code"
    )
    return (
        flight_rows.join(routes.select("route_id", "route_sk"), "route_id", "left")
        .join(aircraft.select("tail_number", "aircraft_sk"), "tail_number", "left")
        .join(origin, "origin_airport_code", "left")
        .join(target, "destination_airport_code", "left")
    )


def flight_columns() -> Columns:
    return [
        surrogate_key("flight_id").alias("flight_sk"),
        "flight_id", "flight_number", "route_sk", "route_id", "aircraft_sk", "tail_number",
        "aircraft_type", "origin_airport_sk", "destination_airport_sk",
        "origin_airport_code", "destination_airport_code", "route_type", "distance_km",
        _date_key(F.col("flight_date")).alias("flight_date_sk"),
        "flight_date", "scheduled_departure_at", "actual_departure_at",
        "scheduled_arrival_at", "actual_arrival_at", "flight_status", "delay_min",
        "seat_capacity", "pax_count", "load_factor", "is_on_time_15", "ticket_revenue_usd",
        "ancillary_revenue_usd", "total_revenue_usd", "fuel_cost_usd", "crew_cost_usd",
        "airport_fees_usd", "maintenance_alloc_usd", "irops_penalty_usd",
        "total_operating_cost_usd", "flight_margin_usd", "flight_margin_pct",
        "disruption_type", "disruption_severity", "disruption_duration_min",
        "root_cause_text", "origin_weather_severity",
        flag(F.col("flight_status") == CANCELLED).alias("is_cancelled"),
        F.col("disruption_type").isNotNull().alias("has_disruption"),
    ]


def flight_keys(flights: DataFrame, routes: DataFrame) -> DataFrame:
    """The keys other facts take from a flight; route columns only for known routes."""
    known = routes.select("route_id", "route_sk")
    here = F.col("route_sk").isNotNull()
    return flights.join(known, "route_id", "left").select(
        "flight_id",
        surrogate_key("flight_id").alias("flight_sk"),
        "flight_date",
        _date_key(F.col("flight_date")).alias("flight_date_sk"),
        "route_sk",
        *[F.when(here, F.col(c)).alias(c) for c in ("route_id", "tail_number", "aircraft_type")],
    )


def fct_bookings(
    bookings: DataFrame, history: DataFrame, customers: DataFrame, flights: DataFrame
) -> DataFrame:
    """One row per booking with the customer version in force on the booking day.

    Bookings older than the first version fall back to the current customer.
    ``flights`` comes from ``flight_keys``. Both customer joins share one shuffle by
    customer, and AQE splits the partitions of frequent ones.
    """
    return fct_bookings_of_flights(bookings.join(flights, "flight_id", "left"), history, customers)


def fct_bookings_of_flights(booked: DataFrame, history: DataFrame, customers: DataFrame) -> DataFrame:
    """``fct_bookings`` of bookings that were joined with their flights' keys before."""
    return booking_rows_of_flights(booked, history, customers).select(*booking_columns())


def booking_rows(
    bookings: DataFrame, history: DataFrame, customers: DataFrame, flights: DataFrame
) -> DataFrame:
    return booking_rows_of_flights(bookings.join(flights, "flight_id", "left"), history, customers)


# What a booking takes from its flight and from the version of its customer, by type.
OF_FLIGHT = {
    "flight_sk": "string", "route_sk": "string", "route_id": "string", "tail_number": "string",
    "aircraft_type": "string", "flight_date_sk": "int", "flight_date": "date",
}
OF_VERSION = {
    "version_dbt_scd_id": "string", "loyalty_tier_at_booking": "string",
    "customer_segment_at_booking": "string",
}


def _unknown(kinds: dict[str, str]) -> dict[str, Column]:
    return {name: F.lit(None).cast(kind) for name, kind in kinds.items()}


def bookings_alone(
    bookings: DataFrame, history: DataFrame | None, customers: DataFrame | None, flights: DataFrame | None
) -> DataFrame:
    """``booking_rows``, but without ``history`` or ``flights`` what these add is null. Without
    ``history``, ``customers`` is needed only where one repeats, as bookings then repeat too."""
    booked = bookings.withColumns(_unknown(OF_FLIGHT)) if flights is None else bookings.join(flights, "flight_id", "left")
    if history is not None:
        return booking_rows_of_flights(booked, history, customers)
    if customers is not None:
        booked = booked.join(customers.select("customer_id"), "customer_id", "left")
    return booked.withColumns({"_flight": F.col("flight_sk").isNotNull(), **_unknown(OF_VERSION)})


def booking_rows_of_flights(booked: DataFrame, history: DataFrame, customers: DataFrame) -> DataFrame:
    known = booked.withColumn("_flight", F.col("flight_sk").isNotNull()).drop("flight_sk")
    versioned = version_in_force(
        known, history, "customer_id", "booking_date",
        ["loyalty_tier", "customer_segment", "dbt_scd_id"],
    )
    now = _renamed(
        customers, customer_id="customer_id", tier_now="loyalty_tier", segment_now="customer_segment"
    )
    return versioned.join(now, "customer_id", "left").select(
        "booking_id", "version_dbt_scd_id", "customer_id",
        F.coalesce("version_loyalty_tier", "tier_now").alias("loyalty_tier_at_booking"),
        F.coalesce("version_customer_segment", "segment_now").alias("customer_segment_at_booking"),
        "_flight", "flight_id", "route_sk", "route_id", "tail_number", "aircraft_type", "fare_class",
        "fare_family", "booking_date", "flight_date_sk", "flight_date", "booking_channel",
        "booking_status", "ticket_price_usd", "ancillary_revenue_usd", "bags_count",
        "seat_selection_flag",
    )


def booking_columns() -> Columns:
    fare = _fare_key()
    premium = F.col("fare_class").isin("Business", "Premium Economy")
    return [
        surrogate_key("booking_id").alias("booking_sk"),
        "booking_id",
        surrogate_key("version_dbt_scd_id").alias("customer_version_sk"),
        "customer_id", "loyalty_tier_at_booking", "customer_segment_at_booking",
        F.when(F.col("_flight"), surrogate_key("flight_id")).alias("flight_sk"),
        "flight_id", "route_sk", "route_id", "tail_number", "aircraft_type",
        fare.alias("fare_sk"), "fare_class", "fare_family",
        F.when(fare.isNotNull(), premium).alias("is_premium_cabin"),
        _date_key(F.col("booking_date")).alias("booking_date_sk"), "booking_date",
        "flight_date_sk", "flight_date", "booking_channel", "booking_status",
        "ticket_price_usd", "ancillary_revenue_usd",
        (F.col("ticket_price_usd") + F.col("ancillary_revenue_usd"))
        .cast("decimal(12,2)").alias("total_booking_revenue_usd"),
        "bags_count", "seat_selection_flag",
        flag(F.col("booking_status") == FLOWN).alias("is_flown"),
    ]


def _buyers(customers: DataFrame, *columns: str) -> DataFrame:
    """Ids of the known customers, to tell where ``customer_sk`` is not null."""
    return customers.select("customer_id", *columns, F.lit(True).alias("_customer"))


def _with_buyers(df: DataFrame, customers: DataFrame | None, *columns: str) -> DataFrame:
    """With what customers add; null without them."""
    if customers is None:
        return df.withColumns(_unknown({"_customer": "boolean", **dict.fromkeys(columns, "string")}))
    return df.join(_buyers(customers, *columns), "customer_id", "left")


def _customer_key() -> Column:
    return F.when(F.col("_customer"), surrogate_key("customer_id")).alias("customer_sk")


def fct_ancillary_offers(offers: DataFrame, bookings: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per offer made on a known booking."""
    return offer_rows(offers, bookings, customers).select(*offer_columns())


# What an offer takes from its booking.
BOOKED = ("booking_id", "customer_id", "flight_id", "fare_class", "fare_family")


def offer_rows(offers: DataFrame, bookings: DataFrame, customers: DataFrame | None) -> DataFrame:
    """Bookings meet their customers first: they are far fewer than offers, which then travel
    once. Without ``customers`` what these add is null."""
    sold = _with_buyers(bookings.select(*BOOKED), customers, "customer_segment", "loyalty_tier")
    return _offer_rows(offers.join(sold, "booking_id"))


def _offer_rows(booked: DataFrame) -> DataFrame:
    return booked.select(
        "ancillary_offer_id", "booking_id", "customer_id", "flight_id", "customer_segment", "loyalty_tier",
        "fare_class", "fare_family", "offer_type", "_customer", "presented_flag", "accepted_flag",
        "offer_price_usd", "offer_at", F.to_date("offer_at").alias("offer_date"),
    )


def fct_offers_of_bookings(booked: DataFrame, customers: DataFrame) -> DataFrame:
    """``fct_ancillary_offers`` of offers that were joined with their bookings before."""
    who = _buyers(customers, "customer_segment", "loyalty_tier")
    return _offer_rows(booked.join(who, "customer_id", "left")).select(*offer_columns())


def offer_columns() -> Columns:
    return [
        surrogate_key("ancillary_offer_id").alias("ancillary_offer_sk"),
        "ancillary_offer_id", "booking_id", _customer_key(), "customer_id",
        "customer_segment", "loyalty_tier", "flight_id",
        _fare_key().alias("fare_sk"), "fare_class", "fare_family",
        _date_key(F.col("offer_date")).alias("offer_date_sk"), "offer_date", "offer_at",
        "offer_type", "offer_price_usd", "presented_flag", "accepted_flag",
        F.when(F.col("accepted_flag"), F.col("offer_price_usd"))
        .otherwise(0).cast("decimal(12,2)").alias("accepted_revenue_usd"),
    ]


def fct_loyalty_events(events: DataFrame, customers: DataFrame, routes: DataFrame) -> DataFrame:
    """One row per earned or redeemed amount of points."""
    return loyalty_rows(events, customers, routes).select(*loyalty_columns())


def loyalty_rows(events: DataFrame, customers: DataFrame | None, routes: DataFrame) -> DataFrame:
    return (
        _with_buyers(events, customers)
        .join(routes.select("route_id", "route_sk"), "route_id", "left")
        .select(
            "loyalty_event_id", "_customer", "customer_id", "route_sk", "route_id", "flight_id",
            "tier_at_event", "event_type", "points_delta",
            F.to_date("event_at").alias("event_date"), "event_at",
        )
    )


def loyalty_columns() -> Columns:
    points = F.col("points_delta")
    return [
        surrogate_key("loyalty_event_id").alias("loyalty_event_sk"),
        "loyalty_event_id", _customer_key(), "customer_id", "route_sk", "route_id",
        "flight_id", "tier_at_event", "event_type", "points_delta",
        F.when(F.col("event_type") == "earn", points).otherwise(0).alias("points_earned"),
        F.when(F.col("event_type") == "redeem", -points).otherwise(0).alias("points_redeemed"),
        _date_key(F.col("event_date")).alias("event_date_sk"), "event_date", "event_at",
    ]


def fct_customer_feedback(
    read: DataFrame, customers: DataFrame, routes: DataFrame, flights: DataFrame
) -> DataFrame:
    """One row per feedback. ``read`` already carries the word features."""
    return feedback_rows(read, customers, routes, flights).select(*feedback_columns())


def feedback_rows(
    read: DataFrame, customers: DataFrame | None, routes: DataFrame, flights: DataFrame | None
) -> DataFrame:
    placed = _with_buyers(read, customers).join(routes.select("route_id", "route_sk"), "route_id", "left")
    if flights is None:
        flown = placed.withColumns(_unknown({"_flight": "boolean"}))
    else:
        flown = placed.join(flights.select("flight_id", F.lit(True).alias("_flight")), "flight_id", "left")
    return (
        flown.select(
            "feedback_id", "_customer", "customer_id", "route_sk", "route_id", "_flight", "flight_id",
            "booking_id", F.to_date("feedback_at").alias("feedback_date"), "feedback_at",
            "feedback_channel", F.col("language_raw").alias("language"), "raw_text", "sentiment_score",
            "sentiment_label", "polarised_word_count", "complaint_category", "all_categories",
            "semantic_tags",
        )
    )


def feedback_columns() -> Columns:
    label = F.col("sentiment_label")
    return [
        surrogate_key("feedback_id").alias("feedback_sk"),
        "feedback_id", _customer_key(), "customer_id", "route_sk", "route_id",
        F.when(F.col("_flight"), surrogate_key("flight_id")).alias("flight_sk"),
        "flight_id", "booking_id", _date_key(F.col("feedback_date")).alias("feedback_date_sk"),
        "feedback_date", "feedback_at", "feedback_channel",
        "language", "raw_text", "sentiment_score",
        "sentiment_label", "polarised_word_count", "complaint_category", "all_categories",
        "semantic_tags",
        flag(label == "negative").alias("is_negative"),
        flag(label == "positive").alias("is_positive"),
    ]
