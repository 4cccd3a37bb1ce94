"""Data checks as jobs. Each yields rows of (table, rule, column, violations, passed)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.frames import stack
from starloom.operators.flights import CANCELLED


@dataclass(frozen=True)
class Check:
    """``values`` for accepted values, ``low``/``high`` for a range, ``parent`` as
    (table, column) for a relationship."""

    table: str
    rule: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: tuple[str, str] | None = None


def _keys(table: str, *columns: str) -> list[Check]:
    return [Check(table, rule, c) for c in columns for rule in ("not_null", "unique")]


def _accepted(table: str, column: str, *values: str) -> Check:
    return Check(table, "accepted_values", column, values=values)


def _parent(table: str, column: str, other: str, field: str | None = None) -> Check:
    return Check(table, "relationships", column, parent=(other, field or column))


def _filled(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c) for c in columns]


# The declared checks on inputs, marts and concepts.
SOURCE_CHECKS = [
    *_keys("airports", "airport_code"),
    *_keys("routes", "route_id"),
    _accepted("routes", "route_type", "Domestic", "Regional", "International"),
    *_keys("aircraft", "tail_number"),
    _accepted("aircraft", "aircraft_type", "A319", "A320", "A320neo", "A330-900neo"),
    *_keys("customers", "customer_id"),
    _accepted("customers", "customer_segment", "Budget", "Standard", "Business", "Premium"),
    *_keys("flights", "flight_id"),
    *_filled("flights", "route_id"),
    _parent("flights", "route_id", "routes"),
    _parent("flights", "tail_number", "aircraft"),
    *_keys("bookings", "booking_id"),
    *_filled("bookings", "customer_id"),
    _parent("bookings", "customer_id", "customers"),
    *_filled("bookings", "flight_id"),
    _parent("bookings", "flight_id", "flights"),
    *_keys("flight_costs", "flight_id"),
    *_keys("disruptions", "disruption_id"),
    *_filled("disruptions", "flight_id"),
    *_filled("weather_daily", "airport_code", "weather_date"),
    *_keys("loyalty_activity", "loyalty_event_id"),
    *_keys("ancillary_offers", "ancillary_offer_id"),
    *_keys("cargo_shipments", "cargo_shipment_id"),
    *_keys("customer_feedback", "feedback_id"),
    *_filled("customer_feedback", "raw_text"),
]
MART_CHECKS = [
    *_keys("dim_date", "date_sk", "date_day"),
    _accepted("dim_date", "season_aviation", "peak", "shoulder", "off_peak"),
    *_keys("dim_airport", "airport_sk", "airport_code"),
    _accepted(
        "dim_airport", "country_group",
        "West Africa", "North Africa", "Middle East", "Europe", "Other",
    ),
    *_keys("dim_route", "route_sk", "route_id"),
    _accepted("dim_route", "route_type", "Domestic", "Regional", "International"),
    _accepted("dim_route", "distance_band", "short_haul", "medium_haul", "long_haul"),
    *_keys("dim_aircraft", "aircraft_sk", "tail_number"),
    *_keys("dim_fare", "fare_sk"),
    _accepted("dim_fare", "fare_class", "Economy", "Premium Economy", "Business"),
    _accepted("dim_fare", "fare_family", "Basic", "Standard", "Flex"),
    *_keys("dim_customer_current", "customer_sk", "customer_id"),
    *_keys("fct_flights", "flight_sk", "flight_id"),
    _parent("fct_flights", "route_sk", "dim_route"),
    _parent("fct_flights", "aircraft_sk", "dim_aircraft"),
    _parent("fct_flights", "flight_date_sk", "dim_date", "date_sk"),
    Check("fct_flights", "range", "load_factor", low=0, high=1.05),
    _accepted("fct_flights", "flight_status", "On Time", "Delayed", "Cancelled"),
    *_keys("fct_bookings", "booking_sk", "booking_id"),
    _parent("fct_bookings", "flight_sk", "fct_flights"),
    _parent("fct_bookings", "route_sk", "dim_route"),
    _parent("fct_bookings", "fare_sk", "dim_fare"),
    _accepted("fct_bookings", "booking_status", "Flown", "Confirmed", "No Show", "Changed"),
    *_keys("fct_customer_feedback", "feedback_sk", "feedback_id"),
    Check("fct_customer_feedback", "range", "sentiment_score", low=-1, high=1),
    _accepted("fct_customer_feedback", "sentiment_label", "negative", "neutral", "positive"),
    *_keys("fct_ancillary_offers", "ancillary_offer_sk", "ancillary_offer_id"),
    *_keys("fct_loyalty_events", "loyalty_event_sk", "loyalty_event_id"),
    _accepted("fct_loyalty_events", "event_type", "earn", "redeem"),
]


def _concept(table: str, key: str, concept: str) -> list[Check]:
    return [*_keys(table, key), _accepted(table, "ontology_concept", concept)]


CONCEPT_CHECKS = [
    *_concept("ont_high_value_at_risk_customer", "customer_id", "HighValueAtRiskCustomer"),
    *_concept("ont_strategic_underperforming_route", "route_id", "StrategicUnderperformingRoute"),
    *_concept("ont_premium_upsell_candidate", "customer_id", "PremiumUpsellCandidate"),
    *_concept("ont_loyal_detractor", "customer_id", "LoyalDetractor"),
    *_concept("ont_irops_heavy_route", "route_id", "IROPSHeavyRoute"),
]


def _row(table: str, rule: str, column: str, violations: Column) -> Column:
    count = F.coalesce(violations, F.lit(0)).cast("long")
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column"),
        count.alias("violations"),
        (count == 0).alias("passed"),
    )


def _row_rule(check: Check) -> Column:
    column = F.col(check.column)
    if check.rule == "not_null":
        return column.isNull()
    if check.rule == "accepted_values":
        return ~column.isin(*check.values)
    return ~column.between(check.low, check.high)


def _row_rules(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All rules of one table that look at single rows: one pass."""
    counts = [F.count_if(_row_rule(c)).alias(f"v{i}") for i, c in enumerate(checks)]
    rows = [_row(c.table, c.rule, c.column, F.col(f"v{i}")) for i, c in enumerate(checks)]
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _per_key(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column. All rules on a column start from this one grouping,
    whose exchange Spark then uses again."""
    return df.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_n"))


def _unique(df: DataFrame, check: Check) -> DataFrame:
    """Counts the values that occur more than once."""
    repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("v")
    counted = _per_key(df, check.column).agg(repeated)
    return counted.select(_row(check.table, check.rule, check.column, F.col("v")).alias("r")).select("r.*")


def _relationship(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Counts child rows without a parent; both sides are counted per key first, so a
    frequent key is one row in the join."""
    child = _per_key(df, check.column).where("_key is not null")
    known = _per_key(parent, check.parent[1]).select("_key")
    orphans = child.join(known, "_key", "left_anti").agg(F.sum("_n").alias("v"))
    return orphans.select(_row(check.table, check.rule, check.column, F.col("v")).alias("r")).select("r.*")


def run_checks(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One report over all checks."""
    frames = {name: tables[name] for c in checks for name in (c.table, *(c.parent or ())[:1])}
    by_table = defaultdict(list)
    parts = []
    for check in checks:
        if check.rule == "unique":
            parts.append(_unique(frames[check.table], check))
        elif check.rule == "relationships":
            parts.append(_relationship(frames[check.table], frames[check.parent[0]], check))
        else:
            by_table[check.table].append(check)
    for table, own in by_table.items():
        parts.append(_row_rules(frames[table], own))
    return stack(parts)


def assertions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The three whole-rule checks; each counts the rows that break its rule."""
    at_risk = tables["ont_high_value_at_risk_customer"].agg(
        F.count_if(
            (F.col("complaint_count") == 0)
            & (F.col("avg_sentiment") >= 0)
            & (F.col("churn_risk_score") < 0.4)
        ).alias("v")
    )
    detractor = tables["ont_loyal_detractor"].agg(
        F.count_if(F.col("loyalty_tier") != "Gold").alias("v")
    )
    strategic = tables["dim_route"].where("is_strategic").select("route_id")
    route = (
        tables["ont_strategic_underperforming_route"]
        .join(strategic, "route_id", "left_anti")
        .agg(F.count("*").alias("v"))
    )
    parts = [
        (at_risk, "ont_high_value_at_risk_customer", "has_signal"),
        (detractor, "ont_loyal_detractor", "is_gold"),
        (route, "ont_strategic_underperforming_route", "is_strategic"),
    ]
    rows = [df.select(_row(t, "assertion", c, F.col("v")).alias("r")).select("r.*") for df, t, c in parts]
    return stack(rows)


@dataclass(frozen=True)
class Above:
    """A lower bound that a value has to exceed."""

    limit: float


# Bounds of the validation figures, both ends included unless a lower one is
# to be exceeded; None is open.
BOUNDS = {
    "airports_rows": (13, None),
    "routes_rows": (16, None),
    "aircraft_rows": (9, 9),
    "customers_rows": (1000, 1000),
    "flights_rows": (Above(8000), None),
    "bookings_rows": (Above(500_000), None),
    "costs_minus_flights": (0, 0),
    "feedback_rows": (3000, 3000),
    "mean_load_factor": (0.60, 0.90),
    "max_load_factor": (None, 1.05),
    "cancellation_rate": (0.01, 0.07),
    "on_time_rate": (0.55, 0.80),
    "attach_rate": (0.70, 0.90),
    "active_customer_share": (0.70, 0.90),
    "french_share": (0.55, 0.75),
    "texts_missing": (0, 0),
    "mean_text_length": (Above(30), None),
}
SUBSETS = [
    _parent("flights", "route_id", "routes"),
    _parent("flights", "tail_number", "aircraft"),
    _parent("bookings", "customer_id", "customers"),
    _parent("bookings", "flight_id", "flights"),
    _parent("disruptions", "flight_id", "flights"),
    _parent("flight_costs", "flight_id", "flights"),
    _parent("customer_feedback", "customer_id", "customers"),
]


def _figures(df: DataFrame, **values: Column) -> DataFrame:
    """One pass over a table, giving one (figure, value) row per aggregate."""
    pairs = [
        F.struct(F.lit(name).alias("figure"), F.col(name).cast("double").alias("value"))
        for name in values
    ]
    one = df.agg(*[v.alias(n) for n, v in values.items()])
    return one.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def _share(condition: Column, of: Column | None = None) -> Column:
    return F.try_divide(F.count_if(condition), F.count_if(of) if of is not None else F.count("*"))


def figures(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Volumes, realism and text figures of the inputs."""
    flights, bookings = tables["flights"], tables["bookings"]
    operated = F.col("flight_status") != CANCELLED
    per_flight = bookings.groupBy("flight_id").agg(F.count("*").alias("n"))
    filled = flights.join(per_flight, "flight_id").select(
        F.try_divide(F.col("n").cast("double"), F.col("seat_capacity").cast("double")).alias("fill")
    )
    counts = F.count("*")
    cost_rows = tables["flight_costs"].select(F.lit(1).alias("n"))
    flight_rows = flights.select(F.lit(-1).alias("n"))
    known = tables["customers"].select(F.lit(1).alias("n"), F.lit(None).cast("string").alias("who"))
    active = bookings.select(F.lit(0).alias("n"), F.col("customer_id").alias("who"))
    parts = [
        _figures(tables["airports"], airports_rows=counts),
        _figures(tables["routes"], routes_rows=counts),
        _figures(tables["aircraft"], aircraft_rows=counts),
        _figures(tables["customers"], customers_rows=counts),
        _figures(
            flights, flights_rows=counts, cancellation_rate=_share(~operated),
            on_time_rate=_share(operated & (F.col("delay_min") <= 15), operated),
        ),
        _figures(bookings, bookings_rows=counts, attach_rate=_share(F.col("ancillary_revenue_usd") > 0)),
        _figures(cost_rows.unionByName(flight_rows), costs_minus_flights=F.sum("n")),
        _figures(filled, mean_load_factor=F.avg("fill"), max_load_factor=F.max("fill")),
        _figures(
            known.unionByName(active),
            active_customer_share=F.try_divide(F.countDistinct("who"), F.sum("n")),
        ),
        _figures(
            tables["customer_feedback"], feedback_rows=counts,
            french_share=_share(F.col("language") == "fr", F.col("language").isNotNull()),
            texts_missing=F.count_if(F.col("raw_text").isNull()),
            mean_text_length=F.avg(F.length("raw_text")),
        ),
    ]
    return stack(parts)


def validation(tables: Mapping[str, DataFrame], bounds: dict = BOUNDS) -> DataFrame:
    """The figures against their bounds."""
    passed = F.lit(None).cast("boolean")
    for name, (low, high) in bounds.items():
        inside = F.lit(True)
        if isinstance(low, Above):
            inside = inside & (F.col("value") > low.limit)
        elif low is not None:
            inside = inside & (F.col("value") >= low)
        if high is not None:
            inside = inside & (F.col("value") <= high)
        passed = F.when(F.col("figure") == name, F.coalesce(inside, F.lit(False))).otherwise(passed)
    return figures(tables).withColumn("passed", passed)
