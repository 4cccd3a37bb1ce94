"""Dashboard reports: filters, one grouping, an order and a limit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.frames import asked
from starloom.sources.writers import MONTH

# The column that a date range applies to, per table.
TIME_COLUMNS = {
    "fct_flights": "flight_date",
    "fct_bookings": "booking_date",
    "fct_customer_feedback": "feedback_date",
    "fct_ancillary_offers": "offer_date",
    "fct_loyalty_events": "event_date",
    "int_route_monthly_perf": "period_month",
    "int_route_complaint_themes": "period_month",
    "dim_date": "date_day",
}


def total(column: str) -> str:
    return f"sum({column})"


def mean(column: str) -> str:
    return f"avg({column})"


def rows() -> str:
    return "count(*)"


def share(numerator: str, denominator: str) -> str:
    """Ratio of two aggregates in double; null where the denominator is zero."""
    return f"try_divide(cast({numerator} as double), cast({denominator} as double))"


def when(condition: str) -> str:
    return f"count_if({condition})"


@dataclass(frozen=True)
class Report:
    """``metrics`` set: grouped; empty: raw rows of ``columns``. ``order`` lists
    columns, a leading minus meaning descending; it should end in a unique key."""

    table: str
    group_by: list[str] = field(default_factory=list)
    metrics: dict[str, str] = field(default_factory=dict)
    columns: list[str] = field(default_factory=list)
    where: str = ""
    order: list[str] = field(default_factory=list)
    limit: int = 0
    newest: bool = False  # what the limit keeps is the end of the order, not its start
    month_grain: str = ""


_AS_DECLARED = -1


# The dashboard's queries.
_MARGIN = share(total("margin_usd"), total("revenue_usd"))
_FILL = share(total("total_pax"), total("total_seat_capacity"))
_UPSELL = [
    "customer_id", "customer_segment", "loyalty_tier", "upgrade_offers_presented",
    "upgrade_offers_accepted", "upgrade_acceptance_rate",
]
REPORTS = {
    "revenue_by_route": Report(
        "int_route_monthly_perf", ["route_id"], {"revenue": total("revenue_usd")},
        order=["-revenue", "route_id"], limit=20,
    ),
    "route_opportunity_matrix": Report(
        "int_route_monthly_perf", ["route_id"],
        {"load_factor": mean("load_factor"), "margin_pct": _MARGIN, "revenue": total("revenue_usd")},
        order=["-revenue", "route_id"], limit=50,
    ),
    "route_kpi_drilldown": Report(
        "int_route_monthly_perf", ["route_id", "period_month"],
        {"revenue": total("revenue_usd"), "margin_pct": _MARGIN, "load_factor": _FILL,
         "otp15": mean("otp15_rate"), "cancel_rate": mean("cancellation_rate"),
         "pax": total("total_pax"), "flights": total("flights_scheduled")},
        order=["-period_month", "route_id"], limit=200,
    ),
    "punctuality_trend": Report(
        "int_route_monthly_perf", ["period_month"],
        {"otp15": mean("otp15_rate"), "cancel_rate": mean("cancellation_rate")},
        order=["period_month"], limit=50, newest=True,
    ),
    "yield_by_route_type": Report(
        "fct_flights", ["route_type"],
        {"rask": share(total("total_revenue_usd"), total("seat_capacity * distance_km"))},
        order=["-rask", "route_type"], limit=10,
    ),
    "disruptions_by_type": Report(
        "fct_flights", ["disruption_type"], {"disruption_count": rows()},
        where="disruption_type is not null", order=["-disruption_count", "disruption_type"], limit=15,
    ),
    "at_risk_customers": Report(
        "ont_high_value_at_risk_customer",
        columns=["customer_id", "last_booking_date", "recency_days", "monetary_total_usd",
                 "complaint_count", "avg_sentiment", "churn_risk_score"],
        order=["-monetary_total_usd", "customer_id"], limit=20,
    ),
    "complaint_heatmap": Report(
        "int_route_complaint_themes", ["route_id", "top_theme_1"],
        {"avg_sentiment": mean("avg_sentiment")}, order=["route_id", "top_theme_1"], limit=200,
    ),
    "sentiment_trend": Report(
        "fct_customer_feedback", ["feedback_date"], {"avg_sentiment": mean("sentiment_score")},
        order=["feedback_date"], limit=50, newest=True, month_grain="feedback_date",
    ),
    "upgrade_conversion_by_tier": Report(
        "fct_ancillary_offers", ["loyalty_tier"],
        {"conversion_rate": share(when("accepted_flag"), when("presented_flag"))},
        where="offer_type in ('upgrade_W', 'upgrade_J') and loyalty_tier is not null",
        order=["-conversion_rate", "loyalty_tier"], limit=10,
    ),
    "attach_rate_by_segment": Report(
        "fct_bookings", ["customer_segment_at_booking"],
        {"attach_rate": share(when("ancillary_revenue_usd > 0"), rows())},
        order=["-attach_rate", "customer_segment_at_booking"], limit=10,
    ),
    "revenue_per_booking_by_fare": Report(
        "fct_bookings", ["fare_class"],
        {"revenue_per_pax": share(total("ticket_price_usd + ancillary_revenue_usd"), rows())},
        order=["-revenue_per_pax", "fare_class"], limit=10,
    ),
    "upsell_candidates": Report(
        "ont_premium_upsell_candidate", columns=_UPSELL,
        order=["-upgrade_acceptance_rate", "customer_id"], limit=20,
    ),
    "routes_to_grow": Report(
        "int_route_monthly_perf", ["route_id"],
        {"revenue": total("revenue_usd"), "margin_pct": _MARGIN, "load_factor": _FILL},
        order=["-revenue", "route_id"], limit=10,
    ),
    "routes_to_defend": Report(
        "ont_irops_heavy_route",
        columns=["route_id", "route_type", "is_strategic", "total_flights_12m",
                 "cancellation_rate_12m", "disruption_rate_12m"],
        order=["-disruption_rate_12m", "route_id"], limit=20,
    ),
    "customers_to_retain": Report(
        "ont_high_value_at_risk_customer",
        columns=["customer_id", "monetary_total_usd", "recency_days", "complaint_count",
                 "avg_sentiment", "ltv_proxy_usd"],
        order=["-ltv_proxy_usd", "customer_id"], limit=50,
    ),
    "offers_to_prioritise": Report(
        "ont_premium_upsell_candidate", columns=_UPSELL,
        order=["-upgrade_acceptance_rate", "customer_id"], limit=50,
    ),
}


def filtered(
    df: DataFrame,
    table: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
    routes: list[str] | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Page filters: ``since <= time < until`` on the table's time column, a choice of
    routes, and a choice of calendar rows (``days``, from the date dimension). A table
    without the column is left as it is.

    Of a table written by month, only the folders of the range are read; of those of
    ``days``, which are known only as the query runs, too (dynamic pruning).
    """
    time = TIME_COLUMNS.get(table)
    by_month = MONTH in df.columns
    if time and by_month and since is not None:
        df = df.where(F.col(MONTH) >= F.lit(since.replace(day=1)))
    if time and by_month and until is not None:
        df = df.where(F.col(MONTH) < F.lit(until))
    if time and days is not None:
        chosen = days.select(F.col("date_day").alias("_day"), F.col("month_start_date").alias("_month"))
        met = F.col(time) == F.col("_day")
        if by_month:
            met = met & (F.col(MONTH) == F.col("_month"))
        df = df.join(F.broadcast(chosen), met, "left_semi")  # the calendar: 1,461 rows
    if time:
        if since is not None:
            df = df.where(F.col(time) >= F.lit(since))
        if until is not None:
            df = df.where(F.col(time) < F.lit(until))
    if routes and "route_id" in df.columns:
        df = df.where(F.col("route_id").isin(*routes))
    return df


def _order(names: list[str]) -> list[Column]:
    return [
        F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_last()
        for n in names
    ]


def _shown(
    tables: Mapping[str, DataFrame], table: str, routes: list[str] | None, *texts: str
) -> DataFrame:
    """A table with the columns that the texts name and the page filters need."""
    filters = [TIME_COLUMNS.get(table, ""), "route_id" if routes else ""]
    return asked(tables, table, *texts, *filters)


def report(
    name: str,
    tables: Mapping[str, DataFrame],
    since: dt.date | None = None,
    until: dt.date | None = None,
    routes: list[str] | None = None,
    limit: int | None = _AS_DECLARED,
    days: DataFrame | None = None,
) -> DataFrame:
    """Run one report, with the page filters applied to the rows first.

    ``limit`` replaces the declared number of rows; None gives every row. Trends keep
    their newest months.
    """
    spec = REPORTS[name]
    named = [*spec.group_by, *spec.metrics.values(), *spec.columns, spec.where, spec.month_grain, *spec.order]
    df = filtered(_shown(tables, spec.table, routes, *named), spec.table, since, until, routes, days)
    if spec.where:
        df = df.where(spec.where)
    if spec.month_grain:
        df = df.withColumn(spec.month_grain, F.trunc(spec.month_grain, "month"))
    if spec.metrics:
        df = df.groupBy(*spec.group_by).agg(
            *[F.expr(text).alias(label) for label, text in spec.metrics.items()]
        )
    else:
        df = df.select(*spec.columns)
    limit = spec.limit if limit == _AS_DECLARED else limit
    if limit is None:
        return df.orderBy(*_order(spec.order))
    if spec.newest:
        turned = [n[1:] if n.startswith("-") else f"-{n}" for n in spec.order]
        df = df.orderBy(*_order(turned)).limit(limit)
        return df.orderBy(*_order(spec.order))
    return df.orderBy(*_order(spec.order)).limit(limit)


def segment_matrix(
    customers: DataFrame,
    tiers: tuple[str, ...] = ("Explorer", "Silver", "Gold", "non_member"),
) -> DataFrame:
    """Customers per segment and tier with row and column totals.

    ``cube`` counts the cells and every total in one pass; the pivot then works on at
    most one row per cell.
    """
    segment, tier = "customer_segment", "loyalty_tier_safe"
    cells = customers.cube(segment, tier).agg(
        F.count("*").alias("n"),
        F.grouping(segment).alias("all_segments"),
        F.grouping(tier).alias("all_tiers"),
    )
    name = F.when(F.col("all_segments") == 1, "Total").otherwise(F.col(segment))
    column = F.when(F.col("all_tiers") == 1, "total").otherwise(F.col(tier))
    wide = cells.groupBy(name.alias("segment"))
    picks = [F.coalesce(F.sum(F.when(column == t, F.col("n"))), F.lit(0)).alias(t) for t in (*tiers, "total")]
    return wide.agg(*picks)


def points_per_member(events: DataFrame, today: dt.date) -> DataFrame:
    """Points earned per active member over the year before ``today``."""
    day = F.col("event_date")
    year = (day >= F.add_months(F.lit(today), -12)) & (day < F.lit(today))
    value = F.try_divide(
        F.sum("points_earned").cast("double"), F.countDistinct("customer_id").cast("double")
    )
    return events.where(year).agg(value.alias("points_per_member"))


# What a page shows of a fact: the amount that is summed, and what rows are grouped by.
PAGES = {
    "fct_flights": ("total_revenue_usd", "route_id"),
    "fct_bookings": ("total_booking_revenue_usd", "route_id"),
    "fct_ancillary_offers": ("accepted_revenue_usd", "offer_type"),
    "fct_loyalty_events": ("points_earned", "route_id"),
    "fct_customer_feedback": ("polarised_word_count", "route_id"),
}


def page(
    table: str,
    tables: Mapping[str, DataFrame],
    since: dt.date | None = None,
    until: dt.date | None = None,
    routes: list[str] | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Rows and amount of a fact by month, under the page filters. A fact without a route
    is filtered by time alone."""
    amount, group = PAGES[table]
    df = filtered(_shown(tables, table, routes, amount, group), table, since, until, routes, days)
    month = F.trunc(TIME_COLUMNS[table], "month").alias("month")
    return df.groupBy(month, group).agg(
        F.count("*").alias("n_rows"), F.sum(amount).cast("double").alias("amount")
    )
