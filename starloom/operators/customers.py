"""Customer value: recency, frequency, spend, offers, churn."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import ratio_of_positive
from starloom.functions.ranks import Rank, add_ranks
from starloom.sources.writers import MONTH

RFM_RANKS = [
    Rank("r_score", "recency_days", "ntile", descending=True),
    Rank("f_score", "frequency_12m", "ntile"),
    Rank("m_score", "monetary_12m_usd", "ntile"),
    Rank("monetary_12m_percentile", "monetary_12m_usd"),
]


def rfm_base(
    bookings: DataFrame,
    statuses: tuple[str, ...] = ("Flown", "Confirmed"),
    window_days: int = 365,
) -> DataFrame:
    """Last date, recency, counts and spend per customer.

    The reference day is the latest booking, found by a scalar subquery.
    """
    kept = bookings.where(F.col("booking_status").isin(*statuses))
    latest = kept.agg(F.max("booking_date")).scalar()
    spend = F.col("ticket_price_usd") + F.col("ancillary_revenue_usd")
    recent = F.datediff(latest, F.col("booking_date")) <= window_days
    last = F.max("booking_date")
    return (
        kept.groupBy("customer_id")
        .agg(
            last.alias("last_booking_date"),
            F.datediff(latest, last).alias("recency_days"),
            F.count("*").alias("frequency_total"),
            F.count_if(recent).alias("frequency_12m"),
            F.sum(spend).cast("decimal(38,2)").alias("monetary_total_usd"),
            F.sum(F.when(recent, spend).otherwise(0)).cast("decimal(38,2)").alias("monetary_12m_usd"),
        )
    )


def daily_spend(bookings: DataFrame, statuses: tuple[str, ...] = ("Flown", "Confirmed")) -> DataFrame:
    """Bookings and spend per customer and day: what the recency table needs of bookings. A
    further day adds its own rows, and reads no other."""
    spend = F.col("ticket_price_usd") + F.col("ancillary_revenue_usd")
    return (
        bookings.where(F.col("booking_status").isin(*statuses))
        .groupBy("customer_id", "booking_date")
        .agg(F.count("*").alias("bookings"), F.sum(spend).cast("decimal(38,2)").alias("spend_usd"))
    )


def rfm_base_of_days(daily: DataFrame, window_days: int = 365) -> DataFrame:
    """``rfm_base`` from ``daily_spend``, stored by month of ``booking_date``. The sums of the
    last days read only the months they lie in."""
    latest = daily.agg(F.max("booking_date")).first()[0]
    spent = F.col("spend_usd")
    total = daily.groupBy("customer_id").agg(
        F.max("booking_date").alias("last_booking_date"),
        F.sum("bookings").alias("frequency_total"),
        F.sum(spent).cast("decimal(38,2)").alias("monetary_total_usd"),
    )
    if latest is None:
        recent = daily.where("false")
    else:
        first = latest - dt.timedelta(days=window_days)
        recent = daily.where((F.col(MONTH) >= F.lit(first.replace(day=1))) & (F.col("booking_date") >= F.lit(first)))
    recent = recent.groupBy(F.col("customer_id").alias("_customer")).agg(
        F.sum("bookings").alias("_bookings"), F.sum(spent).alias("_spend")
    )
    met = total.join(recent, F.col("customer_id").eqNullSafe(F.col("_customer")), "left")
    return met.select(
        "customer_id", "last_booking_date",
        F.datediff(F.lit(latest).cast("date"), "last_booking_date").alias("recency_days"),
        "frequency_total", F.coalesce("_bookings", F.lit(0)).alias("frequency_12m"),
        "monetary_total_usd", F.coalesce("_spend", F.lit(0)).cast("decimal(38,2)").alias("monetary_12m_usd"),
    )


def rfm(base: DataFrame) -> DataFrame:
    """Add quintile scores and the spend percentile; ``base`` is a written table."""
    return add_ranks(base, "customer_id", RFM_RANKS)


def offers_per_customer(bookings: DataFrame, offers: DataFrame) -> DataFrame:
    """Accepted and presented offers per customer over all their bookings.

    Offers are counted per booking first, so a booking meets one row.
    """
    per_booking = offers.groupBy("booking_id").agg(
        F.count_if("accepted_flag").alias("accepted"),
        F.count("ancillary_offer_id").alias("presented"),
    )
    return (
        bookings.select("booking_id", "customer_id")
        .join(per_booking, "booking_id", "left")
        .groupBy("customer_id")
        .agg(
            F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted_offers"),
            F.coalesce(F.sum("presented"), F.lit(0)).alias("presented_offers"),
        )
    )


def lifetime(scored: DataFrame, offers: DataFrame) -> DataFrame:
    """Value proxy and churn risk per customer."""
    accepted = F.coalesce("accepted_offers", F.lit(0))
    presented = F.coalesce("presented_offers", F.lit(0))
    years = F.col("recency_days").cast("double") / 365.0
    idle = F.when(F.col("frequency_12m") == 0, 0.4).otherwise(0.0)
    loyalty = 1 + F.ln(F.greatest(F.col("frequency_total"), F.lit(1)))
    return scored.join(offers, "customer_id", "left").select(
        *scored.columns,
        accepted.alias("accepted_offers"),
        presented.alias("presented_offers"),
        ratio_of_positive(accepted, presented).alias("offer_acceptance_rate"),
        (F.col("monetary_total_usd").cast("double") * loyalty).alias("ltv_proxy_usd"),
        F.least(F.lit(1.0), years * 0.6 + idle).alias("churn_risk_score"),
    )
