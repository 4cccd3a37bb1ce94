"""Deterministic rules that derive operational and commercial columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.quantiles import quantiles
from starloom.operators.flights import CANCELLED, FLOWN

# Capacities, rates, eligibility and propensities.
STRATEGIC_ROUTES = ("R009", "R013", "R014", "R016")
TYPE_CAPACITY = {"A319": 122, "A320": 150, "A320neo": 150, "A330-900neo": 281}
BLOCK_HOUR_USD = {"A319": 3400, "A320": 3600, "A320neo": 2900, "A330-900neo": 7200}
BLOCK_HOUR_DEFAULT_USD = 3500
POINTS_PER_KM = {"Explorer": 1.0, "Silver": 1.25, "Gold": 1.5}
DEFAULT_DISTANCE_KM = 500
OFFER_ACCEPTANCE = {
    "seat_selection": 0.45, "extra_bag": 0.30, "upgrade_W": 0.10,
    "upgrade_J": 0.05, "lounge_access": 0.15, "priority_board": 0.20,
}
OFFER_FARE = {"upgrade_W": "Economy", "upgrade_J": "Premium Economy"}
SEGMENT_LIFT = {"Premium": 1.7, "Business": 1.4}
TIER_LIFT = {"Gold": 1.3}
ACCEPTANCE_CAP = 0.95
CARGO_MIN_KM = 2500
FEEDBACK_BASE, FEEDBACK_DISRUPTED, FEEDBACK_BUSINESS = 0.018, 0.085, 0.025
QUICK_NEGATIVE = [
    "perdu", "retardé", "désagréable", "cassé", "delay", "lost", "rude", "poor", "bad",
    "nightmare", "déçu", "inacceptable",
]
QUICK_POSITIVE = [
    "bravo", "parfait", "excellent", "outstanding", "merci", "great", "smooth", "fantastique",
]


def mapped(column: Column, values: dict, default=None) -> Column:
    """Look a column up in a few literal values."""
    out = F.lit(default)
    for key, value in values.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def append_rows(base: DataFrame, extra: DataFrame, **fill: str) -> DataFrame:
    """Add rows to a reference table; ``fill`` sets columns the base rows lack."""
    for column, value in fill.items():
        base = base.withColumn(column, F.lit(value))
    return base.unionByName(extra, allowMissingColumns=True)


def tag_strategic(routes: DataFrame, ids: tuple[str, ...] = STRATEGIC_ROUTES) -> DataFrame:
    return routes.withColumn("is_strategic", F.col("route_id").isin(*ids))


def with_capacity(aircraft: DataFrame) -> DataFrame:
    """Total seats from the cabins, and the nominal capacity of the type."""
    seats = F.col("seats_business") + F.col("seats_premium_eco") + F.col("seats_economy")
    return aircraft.withColumns(
        {"total_seats": seats, "typed_capacity": mapped(F.col("aircraft_type"), TYPE_CAPACITY)}
    )


def block_costs(flights: DataFrame) -> DataFrame:
    """Scheduled block hours, 20 minutes at least, and their nominal direct cost."""
    minutes = F.timestamp_diff("SECOND", F.col("scheduled_departure_at"), F.col("scheduled_arrival_at")) / 60.0
    hours = F.greatest(F.coalesce(minutes, F.lit(0.0)), F.lit(20.0)) / 60.0
    rate = mapped(F.col("aircraft_type"), BLOCK_HOUR_USD, BLOCK_HOUR_DEFAULT_USD)
    return flights.select(
        "flight_id",
        F.bround(hours, 3).alias("block_hours"),
        (rate.cast("double") * hours).alias("direct_cost_usd"),
    )


def cost_total(costs: DataFrame) -> DataFrame:
    """Total operating cost as the sum of its parts."""
    parts = ("fuel_cost_usd", "crew_cost_usd", "airport_fees_usd", "maintenance_alloc_usd", "irops_penalty_usd")
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return costs.withColumn("total_operating_cost_usd", total.cast("decimal(12,2)"))


def affected_flights(flights: DataFrame, minor_below: str = "4d") -> DataFrame:
    """Flights to log a disruption for: cancelled, delayed over an hour, and about 30 %
    of the shorter delays.

    The share is drawn by the hash of the flight, so it is the same on every run;
    ``minor_below`` is the bound for its first byte in hex (4d of 100 is 30 %).
    """
    delayed = F.col("flight_status") == "Delayed"
    drawn = F.substring(F.md5("flight_id"), 1, 2) < minor_below
    minor = delayed & F.col("delay_min").between(16, 60) & drawn
    hit = (F.col("flight_status") == CANCELLED) | (delayed & (F.col("delay_min") > 60)) | minor
    return flights.where(hit).dropDuplicates(["flight_id"])


def delay_severity(delay: Column) -> Column:
    """An unknown delay, as of a cancelled flight, counts as 180 minutes."""
    minutes = F.coalesce(delay, F.lit(180))
    return F.when(minutes > 180, "Severe").when(minutes > 60, "Major").otherwise("Minor")


def disruption_rows(flights: DataFrame) -> DataFrame:
    """Severity and duration of the affected flights."""
    return affected_flights(flights).select(
        "flight_id",
        delay_severity(F.col("delay_min")).alias("severity"),
        F.coalesce("delay_min", F.lit(180)).alias("duration_min"),
    )


def weather_severity(rain: Column, wind: Column) -> Column:
    return (
        F.when((rain > 25) | (wind > 40), "High")
        .when((rain > 10) | (wind > 30), "Medium")
        .otherwise("Low")
    )


def points_earned(
    bookings: DataFrame, customers: DataFrame, flights: DataFrame, routes: DataFrame
) -> DataFrame:
    """Points per flown booking of a member: route distance times the tier's rate."""
    members = customers.where(F.col("loyalty_tier").isNotNull()).select(
        "customer_id", F.col("loyalty_tier").alias("tier_at_event")
    )
    legs = flights.select("flight_id", "route_id")
    lengths = routes.select("route_id", "distance_km")
    distance = F.coalesce("distance_km", F.lit(DEFAULT_DISTANCE_KM)).cast("double")
    points = F.bround(distance * mapped(F.col("tier_at_event"), POINTS_PER_KM), 0).cast("int")
    return (
        bookings.where(F.col("booking_status") == FLOWN)
        .select("booking_id", "customer_id", "flight_id", "booking_date")
        .join(members, "customer_id")
        .join(legs, "flight_id", "left")
        .join(lengths, "route_id", "left")
        .select(
            "booking_id", "customer_id", "tier_at_event", F.lit("earn").alias("event_type"),
            points.alias("points_delta"), F.col("booking_date").alias("event_date"),
            "flight_id", "route_id",
        )
    )


def offer_chances(bookings: DataFrame, customers: DataFrame) -> DataFrame:
    """Expected acceptance of each offer type a booking may be shown.

    One row per booking and eligible type; the types are a fixed list of six.
    """
    who = customers.select("customer_id", "customer_segment", "loyalty_tier")
    offers = F.array(
        *[
            F.struct(
                F.lit(name).alias("offer_type"),
                F.lit(base).alias("base"),
                F.lit(OFFER_FARE.get(name)).cast("string").alias("fare"),
            )
            for name, base in OFFER_ACCEPTANCE.items()
        ]
    )
    rows = bookings.join(who, "customer_id", "left").select(
        "booking_id", "fare_class", "customer_segment", "loyalty_tier", F.explode(offers).alias("o")
    )
    eligible = F.col("o.fare").isNull() | (F.col("o.fare") == F.col("fare_class"))
    lift = mapped(F.col("customer_segment"), SEGMENT_LIFT, 1.0)
    tier = mapped(F.col("loyalty_tier"), TIER_LIFT, 1.0)
    chance = F.least(F.col("o.base") * lift * tier, F.lit(ACCEPTANCE_CAP))
    return rows.where(eligible).select(
        "booking_id", F.col("o.offer_type").alias("offer_type"), chance.alias("acceptance")
    )


def cargo_eligible(flights: DataFrame, routes: DataFrame) -> DataFrame:
    """Flights of long routes that were not cancelled."""
    long_routes = routes.where(F.col("distance_km") > CARGO_MIN_KM).select("route_id")
    return flights.where(F.col("flight_status") != CANCELLED).join(long_routes, "route_id", "left_semi")


def feedback_propensity(bookings: DataFrame, disruptions: DataFrame) -> DataFrame:
    """Chance that a flown booking leads to feedback."""
    hit = disruptions.select("flight_id").distinct().withColumn("_hit", F.lit(True))
    base = F.when(F.col("_hit"), FEEDBACK_DISRUPTED).otherwise(FEEDBACK_BASE)
    chance = F.when(
        F.col("fare_class") == "Business", F.greatest(base, F.lit(FEEDBACK_BUSINESS))
    ).otherwise(base)
    return (
        bookings.where(F.col("booking_status") == FLOWN)
        .join(hit, "flight_id", "left")
        .select("booking_id", "flight_id", F.coalesce("_hit", F.lit(False)).alias("has_disruption"),
                chance.alias("propensity"))
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each value of a column, nulls left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    all_rows = df.agg(F.count(column).alias("total"))
    return counts.crossJoin(F.broadcast(all_rows)).select(
        F.lit(column).alias("column"),
        F.col(column).cast("string").alias("value"),
        "n",
        (F.col("n") / F.col("total")).alias("share"),
    )


def load_profile(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """Mean and outer deciles of bookings over capacity; quantiles are interpolated."""
    per_flight = bookings.groupBy("flight_id").agg(F.count("*").alias("n"))
    filled = flights.join(per_flight, "flight_id").select(
        F.try_divide(F.col("n").cast("double"), F.col("seat_capacity").cast("double")).alias("fill")
    )
    deciles = quantiles(filled, "fill", [0.1, 0.9])
    return filled.agg(
        F.avg("fill").alias("mean"),
        F.lit(deciles[0.1]).cast("double").alias("p10"),
        F.lit(deciles[0.9]).cast("double").alias("p90"),
    )


def booking_profile(bookings: DataFrame, customers: DataFrame) -> DataFrame:
    """Volume, mean price, attach rate and share of active customers."""
    base = customers.agg(F.count("*").alias("_customers"))
    money = bookings.agg(
        F.count("*").alias("bookings"),
        F.avg(F.col("ticket_price_usd").cast("double")).alias("mean_price"),
        F.try_divide(F.count_if(F.col("ancillary_revenue_usd") > 0), F.count("*")).alias("attach_rate"),
        F.countDistinct("customer_id").alias("active_customers"),
    )
    return money.crossJoin(F.broadcast(base)).select(
        "bookings", "mean_price", "attach_rate", "active_customers",
        F.try_divide("active_customers", "_customers").alias("active_share"),
    )


def acceptance_by_type(offers: DataFrame) -> DataFrame:
    """Share of accepted offers per type."""
    return offers.groupBy("offer_type").agg(
        (F.count_if("accepted_flag") / F.count("*")).alias("acceptance")
    )


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as many times as a column says, numbered from 1; none for zero."""
    numbers = F.when(F.col(times) > 0, F.sequence(F.lit(1), F.col(times).cast("int")))
    return df.withColumn("copy_no", F.explode(numbers))
