"""Parameterised lookups with checked arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import ratio

ROW_CAP = 1_000
SENTIMENTS = ("negative", "neutral", "positive", "any")


def _within(name: str, value: int, low: int, high: int) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")


def routes_with_kpis(monthly: DataFrame, period_months: int = 12, limit: int = 20) -> DataFrame:
    """Indicators per route over the last months, best revenue first.

    ``monthly`` is read twice, so pass a written table. The window holds exactly
    ``period_months`` months, the latest included.
    """
    _within("period_months", period_months, 1, 24)
    _within("limit", limit, 1, 50)
    before = monthly.agg(F.add_months(F.max("period_month"), -period_months)).scalar()
    revenue = F.sum("revenue_usd")
    return (
        monthly.where(F.col("period_month") > before)
        .groupBy("route_id")
        .agg(
            F.round(revenue, 0).cast("decimal(38,0)").alias("revenue_usd"),
            F.round(ratio(F.sum("margin_usd"), revenue), 4).alias("margin_pct"),
            F.round(ratio(F.sum("total_pax"), F.sum("total_seat_capacity")), 4).alias("load_factor"),
            F.round(F.avg("otp15_rate"), 4).alias("otp15_rate"),
            F.round(F.avg("cancellation_rate"), 4).alias("cancellation_rate"),
        )
        .orderBy(F.col("revenue_usd").desc_nulls_last(), "route_id")
        .limit(limit)
    )


def at_risk_customers(at_risk: DataFrame, limit: int = 20) -> DataFrame:
    """Flagged customers, highest value proxy first."""
    _within("limit", limit, 1, 100)
    return (
        at_risk.select(
            "customer_id", "recency_days", "monetary_total_usd", "ltv_proxy_usd",
            "complaint_count", "avg_sentiment", "churn_risk_score",
        )
        .orderBy(F.col("ltv_proxy_usd").desc_nulls_last(), "customer_id")
        .limit(limit)
    )


def search_feedback(
    feedback: DataFrame, route_id: str | None = None, sentiment: str = "any", limit: int = 10
) -> DataFrame:
    """Feedback texts, worst score first and newest first among equals."""
    if sentiment not in SENTIMENTS:
        raise ValueError(f"sentiment must be one of {SENTIMENTS}")
    _within("limit", limit, 1, 50)
    if route_id:
        feedback = feedback.where(F.col("route_id") == route_id)
    if sentiment != "any":
        feedback = feedback.where(F.col("sentiment_label") == sentiment)
    return (
        feedback.select(
            "feedback_id", "feedback_date", "route_id", "customer_id", "language",
            "sentiment_score", "sentiment_label", "complaint_category", "raw_text",
        )
        .orderBy(
            F.col("sentiment_score").asc_nulls_last(),
            F.col("feedback_date").desc_nulls_last(),
            "feedback_id",
        )
        .limit(limit)
    )


def capped(df: DataFrame, cap: int = ROW_CAP, exact: bool = False) -> tuple[list, bool]:
    """At most ``cap`` rows for a caller, and whether they may be cut off.

    The flag is also set at exactly ``cap`` rows; ``exact`` reads one row more and sets
    it only when there are more.
    """
    rows = df.limit(cap + 1 if exact else cap).collect()
    return rows[:cap], len(rows) > cap if exact else len(rows) == cap


def capped_frame(df: DataFrame, order: list, cap: int = ROW_CAP) -> DataFrame:
    """The first ``cap`` rows in an order that tells rows apart, with ``truncated``: whether
    there are more. Each task keeps one row more than the cap at most."""
    top = df.orderBy(*order).limit(cap + 1)
    # At most cap + 1 rows, so numbering them in one task is bounded.
    numbered = top.withColumn("_nth", F.row_number().over(Window.orderBy(*order)))
    more = F.max("_nth").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return numbered.withColumn("truncated", more > cap).where(F.col("_nth") <= cap).drop("_nth")
