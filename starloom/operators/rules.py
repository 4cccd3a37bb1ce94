"""Business concepts: customers and routes that a rule singles out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import ratio, ratio_of_positive
from starloom.functions.ranks import Rank, add_ranks
from starloom.session import materialise


@dataclass(frozen=True)
class Rule:
    """A named set of predicates, joined by AND or OR."""

    concept: str
    predicates: dict[str, str]
    logic: str = "AND"
    always: list[str] = field(default_factory=list)

    def condition(self) -> Column:
        """``predicates`` maps a column to a comparison such as ``>= 0.6``; ``always``
        holds whole conditions that apply under either logic."""
        parts = [F.expr(f"({column} {test})") for column, test in self.predicates.items()]
        joined = parts[0]
        for part in parts[1:]:
            joined = (joined & part) if self.logic == "AND" else (joined | part)
        for whole in self.always:
            joined = joined & F.expr(f"({whole})")
        return joined

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition()).select(
            "*",
            F.lit(self.concept).alias("ontology_concept"),
            F.current_timestamp().alias("inferred_at"),
        )


# The five concepts and their thresholds.
HIGH_VALUE_AT_RISK = Rule(
    "HighValueAtRiskCustomer",
    {"monetary_total_percentile": ">= 0.60D", "recency_percentile": ">= 0.60D"},
    always=["complaint_count >= 1 OR avg_sentiment < 0 OR churn_risk_score >= 0.40D"],
)
STRATEGIC_UNDERPERFORMING = Rule(
    "StrategicUnderperformingRoute",
    {"margin_percentile_among_strategic": "<= 0.50D", "load_factor_12m": ">= 0.65D"},
)
PREMIUM_UPSELL = Rule(
    "PremiumUpsellCandidate",
    {"acceptance_percentile": ">= 0.75D", "upgrade_offers_presented": ">= 2"},
)
LOYAL_DETRACTOR = Rule(
    "LoyalDetractor", {"frequency_12m": ">= 4", "avg_sentiment_6m": "< -0.3D"}
)
IROPS_HEAVY = Rule(
    "IROPSHeavyRoute",
    {"disruption_percentile": ">= 0.80D", "cancellation_rate_12m": "> 0.05D"},
    logic="OR",
)


def _since(df: DataFrame, first: Column) -> Column:
    """The first day of a window that ends with the last one of ``df``: a scalar subquery,
    so that a comparison with it reaches the scan."""
    return df.agg(first).scalar()


def high_value_at_risk(
    lifetime: DataFrame, feedback: DataFrame, rule: Rule = HIGH_VALUE_AT_RISK
) -> DataFrame:
    """Big spenders drifting away with a sign of discontent; ``lifetime`` is written."""
    ranked = add_ranks(
        lifetime,
        "customer_id",
        [Rank("recency_percentile", "recency_days"), Rank("monetary_total_percentile", "monetary_total_usd")],
    )
    mood = feedback.groupBy("customer_id").agg(
        F.count_if("is_negative").alias("complaint_count"),
        F.avg("sentiment_score").alias("avg_sentiment"),
    )
    joined = ranked.join(mood, "customer_id", "left").select(
        "customer_id", "last_booking_date", "recency_days", "recency_percentile", "frequency_12m",
        "monetary_total_usd", "monetary_total_percentile", "monetary_12m_usd",
        "monetary_12m_percentile", "ltv_proxy_usd", "churn_risk_score",
        F.coalesce("complaint_count", F.lit(0)).alias("complaint_count"),
        F.coalesce("avg_sentiment", F.lit(0.0)).alias("avg_sentiment"),
    )
    return rule.apply(joined)


def strategic_underperforming(
    monthly: DataFrame, routes: DataFrame, rule: Rule = STRATEGIC_UNDERPERFORMING, months: int = 12
) -> DataFrame:
    """Strategic routes in the lower half of margins although well filled.

    ``monthly`` is read twice, so pass a written table. The window keeps the last month
    and the ``months`` before it.
    """
    known = routes.where("is_strategic").select("route_id", "route_type", "distance_band")
    first = _since(monthly, F.add_months(F.max("period_month"), -months))
    revenue, cost = F.sum("revenue_usd"), F.sum("operating_cost_usd")
    per_route = (
        monthly.where(F.col("period_month") >= first)
        .groupBy("route_id")
        .agg(
            F.sum("flights_operated").alias("flights_operated_12m"),
            revenue.cast("decimal(38,2)").alias("revenue_12m"),
            cost.cast("decimal(38,2)").alias("cost_12m"),
            F.sum("margin_usd").cast("decimal(38,2)").alias("margin_12m_usd"),
            ratio_of_positive(revenue - cost, revenue).alias("margin_pct_12m"),
            ratio_of_positive(F.sum("total_pax"), F.sum("total_seat_capacity")).alias("load_factor_12m"),
            F.avg("cancellation_rate").alias("avg_cancellation_rate"),
            F.avg("otp15_rate").alias("avg_otp15"),
        )
        .join(known, "route_id")
    )
    name = "margin_percentile_among_strategic"
    ranked = add_ranks(
        materialise(per_route, "strategic_routes"), "route_id", [Rank(name, "margin_pct_12m")]
    )
    return rule.apply(
        ranked.select(
            "route_id", "route_type", "distance_band", "flights_operated_12m", "revenue_12m",
            "cost_12m", "margin_12m_usd", "margin_pct_12m", name, "load_factor_12m",
            "avg_cancellation_rate", "avg_otp15",
        )
    )


def premium_upsell(
    offers: DataFrame, customers: DataFrame, rule: Rule = PREMIUM_UPSELL,
    segments: tuple[str, ...] = ("Standard", "Business"),
    tiers: tuple[str, ...] = ("Silver", "Gold"),
    offer_types: tuple[str, ...] = ("upgrade_W", "upgrade_J"),
) -> DataFrame:
    """Members whose acceptance of upgrades is in the top quarter."""
    eligible = customers.where(
        F.col("customer_segment").isin(*segments) & F.col("loyalty_tier").isin(*tiers)
    ).select("customer_id", "customer_segment", "loyalty_tier")
    presented, accepted = F.count_if("presented_flag"), F.count_if("accepted_flag")
    per_customer = (
        offers.where(F.col("offer_type").isin(*offer_types))
        .groupBy("customer_id")
        .agg(
            presented.alias("upgrade_offers_presented"),
            accepted.alias("upgrade_offers_accepted"),
            F.coalesce(ratio(accepted, presented), F.lit(0.0)).alias("upgrade_acceptance_rate"),
        )
        .join(eligible, "customer_id")
    )
    ranked = add_ranks(
        materialise(per_customer, "upgrade_offers"), "customer_id",
        [Rank("acceptance_percentile", "upgrade_acceptance_rate")],
    )
    return rule.apply(
        ranked.select(
            "customer_id", "customer_segment", "loyalty_tier", "upgrade_offers_presented",
            "upgrade_offers_accepted", "upgrade_acceptance_rate", "acceptance_percentile",
        )
    )


def loyal_detractor(
    customers: DataFrame, rfm: DataFrame, feedback: DataFrame, rule: Rule = LOYAL_DETRACTOR,
    tier: str = "Gold", days: int = 180,
) -> DataFrame:
    """Frequent top-tier customers whose recent feedback is bad."""
    first = _since(feedback, F.date_sub(F.max("feedback_date"), days))
    recent = (
        feedback.where(F.col("feedback_date") >= first)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("feedback_count_6m"),
            F.avg("sentiment_score").alias("avg_sentiment_6m"),
            F.count_if(F.col("sentiment_label") == "negative").alias("negative_count_6m"),
        )
    )
    members = customers.where(F.col("loyalty_tier") == tier).select(
        "customer_id", "customer_segment", "loyalty_tier"
    )
    joined = members.join(rfm.select("customer_id", "frequency_12m"), "customer_id").join(
        recent, "customer_id"
    )
    return rule.apply(joined)


def irops_heavy(
    flights: DataFrame, routes: DataFrame, rule: Rule = IROPS_HEAVY, months: int = 12
) -> DataFrame:
    """Routes with many disruptions or too many cancellations in the last months."""
    first = _since(flights, F.add_months(F.max("flight_date"), -months))
    total = F.count("*")
    per_route = (
        flights.where(F.col("flight_date") >= first)
        .groupBy("route_id")
        .agg(
            total.alias("total_flights_12m"),
            F.count_if("is_cancelled").alias("cancellations_12m"),
            F.count_if("has_disruption").alias("disruptions_12m"),
            ratio(F.count_if("is_cancelled"), total).alias("cancellation_rate_12m"),
            ratio(F.count_if("has_disruption"), total).alias("disruption_rate_12m"),
        )
    )
    ranked = add_ranks(
        materialise(per_route, "route_operations"), "route_id",
        [Rank("disruption_percentile", "disruption_rate_12m")],
    )
    known = routes.select("route_id", "route_type", "distance_band", "is_strategic")
    return rule.apply(
        known.join(ranked, "route_id").select(
            "route_id", "route_type", "distance_band", "is_strategic", "total_flights_12m",
            "cancellations_12m", "disruptions_12m", "cancellation_rate_12m",
            "disruption_rate_12m", "disruption_percentile",
        )
    )
