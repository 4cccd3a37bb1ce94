"""The query register: every job over the bound tables, with its checking SQL.

``QUERIES`` maps a name to a job, ``CHECKS`` to SQL that a database runs over the same
tables. Results leave here in plain types on both sides: decimals as doubles, dates
as text, lists as comma-joined text.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.frames import asked, stack
from starloom.functions.text import Vocabulary
from starloom.operators import enrichment as enrich
from starloom.operators import facts, feedback, lookups, quality, reports, scd2
from starloom.operators import customers as cust
from starloom.operators import distinct_counts, rule_files, rules
from starloom.operators.colocated import Bucketed, colocated_join, write_bucketed
from starloom.operators.metrics import Metric, MetricLayer
from starloom.plans.history import HistoryStore
from starloom.plans.oracle_views import (
    FIRST_SNAPSHOT,
    SECOND_SNAPSHOT,
    TODAY,
    VIEWS,
    checking_sql,
)
from starloom.plans.warehouse import (
    FACT_COLUMNS,
    FACT_DAYS,
    SPREAD_FACTS,
    AskedTables,
    StoredTables,
    TablesOnDemand,
    Warehouse,
)
from starloom.session import materialise, prepare, shared_folder
from starloom.sources.bindings import BOUND_LEXICON, BOUND_NEGATIONS, BOUND_TAXONOMY, Binder
from starloom.sources.lexicons import seed_frame
from starloom.sources.readers import read_seed, read_source, stage
from starloom.sources.schemas import SOURCES
from starloom.sources.writers import replace_months, write_by_month

Job = Callable[[Warehouse], DataFrame]


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The star schema over the parquet tables in ``folder``."""
    bind = Binder(prepare(spark), folder)

    def history() -> DataFrame:
        earlier = stage(bind("earlier_customers"), "customers").drop("_loaded_at")
        at = dt.datetime.fromisoformat(FIRST_SNAPSHOT)
        return scd2.first_snapshot(earlier, "customer_id", at)

    return Warehouse(
        spark,
        bind,
        Vocabulary(BOUND_LEXICON, BOUND_TAXONOMY, BOUND_NEGATIONS),
        dt.date.fromisoformat(TODAY),
        dt.datetime.fromisoformat(SECOND_SNAPSHOT),
        history,
    )


def shown(df: DataFrame, rounded: str = "") -> DataFrame:
    """Plain types; columns named in ``rounded`` to six digits, as sums of doubles
    depend on their order."""
    out = []
    for f in df.schema.fields:
        text = f"`{f.name}`"
        if isinstance(f.dataType, T.ArrayType):
            text = f"array_join({text}, ',')"
        elif isinstance(f.dataType, T.DecimalType):
            text = f"cast({text} as double)"
        elif isinstance(f.dataType, T.DateType):
            text = f"cast({text} as string)"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = f"date_format({text}, 'yyyy-MM-dd HH:mm:ss')"
        if f.name in rounded.split():
            text = f"round({text}, 6)"
        out.append(f"{text} as `{f.name}`")
    return df.selectExpr(*out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _add(
    name: str, job: Job, sql: str, money: str = "", days: str = "", times: str = "",
    rounded: str = "", drop: str = "", order: str = "",
) -> None:
    """Register a job. ``sql`` is a view name or a SELECT; the column lists say which
    of its columns to show as doubles, days, times or rounded, and which to leave out.
    ``order`` ends the SQL with an order and limit."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = job(warehouse(spark, folder))
        df = df.drop("_loaded_at", "inferred_at", *drop.split())
        return shown(df, rounded)

    changes = [f"cast({c} as double) as {c}" for c in money.split() if c not in rounded.split()]
    changes += [f"cast({c} as varchar) as {c}" for c in days.split()]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in times.split()]
    changes += [f"round(cast({c} as double), 6) as {c}" for c in rounded.split()]
    star = "*"
    if drop:
        star += f" exclude ({', '.join(drop.split())})"
    if changes:
        star += f" replace ({', '.join(changes)})"
    body = f"(select * from {sql} {order}) q" if sql in VIEWS else f"({sql} {order}) q"
    QUERIES[name] = run
    CHECKS[name] = checking_sql(f"select {star} from {body}")


def _table(name: str, table: str | None = None, **kinds: str) -> None:
    """Register a table of the warehouse under a query name."""
    table = table or name
    _add(name, lambda w: w[table], table, **kinds)


_MARTS: dict[tuple[str, str], tuple[str, set[str]]] = {}


def _mart_folder(w: Warehouse) -> tuple[str, set[str]]:
    app = w.spark.sparkContext.applicationId
    key = app, w.inputs.folder
    if key not in _MARTS:
        _MARTS[key] = f"{shared_folder(w.spark)}/starloom/{app}/marts-{uuid.uuid4().hex}", set()
    return _MARTS[key]


def marts(w: Warehouse) -> StoredTables:
    """The built tables over the same inputs, for dashboards: each is built when a session
    first asks for it, with those it is made from, then read from its files."""
    return w.stored or TablesOnDemand(w, *_mart_folder(w))


def questions(w: Warehouse) -> AskedTables:
    """The same tables, but facts for one question are made as it runs, as far as it needs."""
    return AskedTables(w, *_mart_folder(w))


# ---- inputs -------------------------------------------------------------------------

_STAGED = {
    "customers": {"days": "birth_date signup_date"},
    "flights": {
        "days": "flight_date",
        "times": "scheduled_departure_at actual_departure_at scheduled_arrival_at actual_arrival_at",
    },
    "bookings": {"days": "booking_date", "money": "ticket_price_usd ancillary_revenue_usd"},
    "flight_costs": {
        "money": "block_hours fuel_cost_usd crew_cost_usd airport_fees_usd maintenance_alloc_usd "
        "irops_penalty_usd total_operating_cost_usd"
    },
    "weather_daily": {"days": "weather_date", "money": "precipitation_mm wind_kph"},
    "loyalty_activity": {"times": "event_at"},
    "ancillary_offers": {"times": "offer_at", "money": "offer_price_usd"},
    "cargo_shipments": {"money": "weight_kg revenue_usd"},
    "competitors": {"days": "snapshot_month", "money": "avg_fare_usd"},
    "customer_feedback": {"times": "feedback_at"},
}
for _source in SOURCES:
    _table(f"stg_{_source}", **_STAGED.get(_source, {}))

# ---- flights and customers ----------------------------------------------------------

_COSTS = (
    "fuel_cost_usd crew_cost_usd airport_fees_usd maintenance_alloc_usd irops_penalty_usd "
    "total_operating_cost_usd"
)
_FLIGHT_MONEY = f"ticket_revenue_usd ancillary_revenue_usd total_revenue_usd {_COSTS} flight_margin_usd"
_FLIGHT_TIMES = "scheduled_departure_at actual_departure_at scheduled_arrival_at actual_arrival_at"
_RFM_MONEY = "monetary_total_usd monetary_12m_usd"

_table("flight_passengers", "int_flight_passenger_count")
_table(
    "flight_revenue", "int_flight_revenue",
    money="ticket_revenue_usd ancillary_revenue_usd total_revenue_usd",
)
_table("flight_full", "int_flight_full", money=_FLIGHT_MONEY, days="flight_date", times=_FLIGHT_TIMES)
_table(
    "route_monthly_performance", "int_route_monthly_perf", days="period_month",
    money="revenue_usd operating_cost_usd margin_usd",
)
_table("customer_rfm_base", "rfm_base", money=_RFM_MONEY, days="last_booking_date")
_table("customer_rfm", "int_customer_rfm", money=_RFM_MONEY, days="last_booking_date")
_add(
    "customer_rfm_ranged", lambda w: w["int_customer_rfm"], "int_customer_rfm",
    money=_RFM_MONEY, days="last_booking_date",
)
_table("offers_per_customer")
_table(
    "customer_lifetime", "int_customer_lifetime", money=_RFM_MONEY, days="last_booking_date",
    rounded="ltv_proxy_usd churn_risk_score",
)

# ---- text ---------------------------------------------------------------------------

_table("feedback_tokens", "int_feedback_tokens")
_add(
    "polarised_tokens",
    lambda w: feedback.polarised_tokens(
        w["int_feedback_tokens"], seed_frame(w.spark, "lexicon_sentiment", BOUND_LEXICON)
    ),
    "polarised_tokens",
)
_table("feedback_sentiment", "int_feedback_sentiment")
_add(
    "feedback_sentiment_by_join",
    lambda w: feedback.sentiment_by_join(
        w["stg_customer_feedback"],
        seed_frame(w.spark, "lexicon_sentiment", BOUND_LEXICON),
        seed_frame(w.spark, "negation_words", BOUND_NEGATIONS),
    ),
    "int_feedback_sentiment",
)
_add(
    "category_counts",
    lambda w: feedback.category_counts(
        w["int_feedback_tokens"], seed_frame(w.spark, "complaint_taxonomy", BOUND_TAXONOMY)
    ),
    "category_counts",
)
_table("feedback_category", "int_feedback_category")
_table("feedback_tags", "int_feedback_tags")
_table(
    "route_complaint_themes", "int_route_complaint_themes", days="period_month",
    rounded="avg_sentiment negative_ratio positive_ratio",
)
_NEGATIVE, _POSITIVE = ["the", "qui", "lle", *enrich.QUICK_NEGATIVE], ["ing", "ent", *enrich.QUICK_POSITIVE]


def _contained(words: list[str]) -> str:
    return " + ".join(f"(contains(normalised_text, '{w}'))::int" for w in words)


_add(
    "keyword_polarity",
    lambda w: feedback.keyword_polarity(w["stg_customer_feedback"], _NEGATIVE, _POSITIVE),
    f"""select feedback_id, case sign(({_contained(_POSITIVE)}) - ({_contained(_NEGATIVE)}))
               when 1 then 'pos' when -1 then 'neg' else 'neu' end as quick_polarity
        from stg_customer_feedback""",
)

# ---- dimensions and facts -----------------------------------------------------------

_add(
    "bookings_by_calendar",
    lambda w: w["stg_bookings"]
    .join(w["dim_date"], F.col("booking_date") == F.col("date_day"))
    .groupBy(*[c for c in w["dim_date"].columns])
    .agg(F.count("*").alias("bookings")),
    """select dim_date.*, count(*) as bookings
       from stg_bookings join dim_date on booking_date = date_day group by all""",
    days="date_day month_start_date quarter_start_date year_start_date",
)
_table("dim_airport")
_table("dim_aircraft")
_table("dim_fare")
_table("dim_route")
_table(
    "dim_customer_snapshot", days="birth_date signup_date",
    times="dbt_updated_at dbt_valid_from dbt_valid_to",
)
_table("dim_customer_current", days="birth_date signup_date")
_table("fct_flights", money=_FLIGHT_MONEY, days="flight_date", times=_FLIGHT_TIMES)
_table(
    "fct_bookings", money="ticket_price_usd ancillary_revenue_usd total_booking_revenue_usd",
    days="booking_date flight_date",
)
_add(
    "bookings_with_version",
    lambda w: scd2.version_in_force(
        w["stg_bookings"].select("booking_id", "customer_id", "booking_date"),
        w["dim_customer_snapshot"], "customer_id", "booking_date", ["loyalty_tier", "dbt_scd_id"],
    ),
    """select b.booking_id, b.customer_id, b.booking_date, v.loyalty_tier as version_loyalty_tier,
              v.dbt_scd_id as version_dbt_scd_id
       from stg_bookings b left join dim_customer_snapshot v
         on v.customer_id = b.customer_id and dbt_valid_from::date <= b.booking_date
        and (dbt_valid_to is null or dbt_valid_to::date > b.booking_date)""",
    days="booking_date",
)
_table(
    "fct_ancillary_offers", money="offer_price_usd accepted_revenue_usd", days="offer_date", times="offer_at"
)
_table("fct_loyalty_events", days="event_date", times="event_at")
_table("fct_customer_feedback", days="feedback_date", times="feedback_at")

# ---- concepts -----------------------------------------------------------------------

_RISK = {
    "money": _RFM_MONEY, "days": "last_booking_date",
    "rounded": "ltv_proxy_usd churn_risk_score avg_sentiment",
}
_table("high_value_at_risk", "ont_high_value_at_risk_customer", **_RISK)
_add(
    "high_value_at_risk_ranged", lambda w: w["ont_high_value_at_risk_customer"],
    "ont_high_value_at_risk_customer", **_RISK,
)
_table(
    "strategic_underperforming", "ont_strategic_underperforming_route",
    money="revenue_12m cost_12m margin_12m_usd", rounded="avg_cancellation_rate avg_otp15",
)
_table("premium_upsell", "ont_premium_upsell_candidate")
_table("loyal_detractor", "ont_loyal_detractor", rounded="avg_sentiment_6m")
_table("irops_heavy", "ont_irops_heavy_route")

# ---- metrics ------------------------------------------------------------------------


def _metrics(name: str, sql: str, rounded: str = "", days: str = "", money: str = "", **ask) -> None:
    def job(w: Warehouse) -> DataFrame:
        question = dict(ask)
        if question.pop("fill", False):
            question["spine"] = w["metricflow_time_spine"]
        return MetricLayer(questions(w)).query(**question)

    _add(name, job, sql, rounded=rounded, days=days, money=money)


_metrics(
    "metrics_flights_by_month",
    """select date_trunc('month', flight_date)::date as metric_time, route_type,
              count(*) as m_flights_scheduled,
              count(*) filter (flight_status != 'Cancelled') as m_flights_operated,
              count(*) filter (flight_status = 'Cancelled') as m_flights_cancelled,
              count(*) filter (is_on_time_15) as m_flights_on_time,
              sum(pax_count)::bigint as m_pax, sum(seat_capacity)::bigint as m_seat_capacity,
              sum(total_revenue_usd)::double as m_revenue, sum(flight_margin_usd)::double as m_margin
       from fct_flights group by all""",
    days="metric_time",
    metrics=["m_flights_scheduled", "m_flights_operated", "m_flights_cancelled", "m_flights_on_time",
             "m_pax", "m_seat_capacity", "m_revenue", "m_margin"],
    group_by=["route_type"], grain="month",
)
_metrics(
    "metrics_flight_ratios",
    """select distance_band,
              (sum(total_revenue_usd) filter (flight_status != 'Cancelled'))::double as route_revenue,
              sum(flight_margin_usd)::double / sum(total_revenue_usd)::double as route_margin_pct,
              sum(pax_count) / sum(seat_capacity) as load_factor,
              1 - count(*) filter (is_on_time_15) / count(*) filter (flight_status != 'Cancelled') as delay_rate,
              avg(is_cancelled::int) as cancellation_rate
       from (select *, case when distance_km < 800 then 'short_haul' when distance_km < 3500
                            then 'medium_haul' else 'long_haul' end as distance_band from fct_flights)
       group by all""",
    rounded="route_margin_pct load_factor delay_rate cancellation_rate",
    metrics=["route_revenue", "route_margin_pct", "load_factor", "delay_rate", "cancellation_rate"],
    group_by=["distance_band"],
)
_metrics(
    "metrics_bookings_by_fare",
    """select fare_class, booking_channel, count(*) as m_bookings,
              count(distinct customer_id) as m_unique_customers, count(distinct customer_id) as customer_count,
              (count(*) - count(distinct customer_id)) / count(*) as repeat_booking_rate,
              count(*) filter (ancillary_revenue_usd > 0) / count(*) as ancillary_attach_rate
       from fct_bookings group by all""",
    rounded="repeat_booking_rate ancillary_attach_rate",
    metrics=["m_bookings", "m_unique_customers", "customer_count", "repeat_booking_rate",
             "ancillary_attach_rate"],
    group_by=["fare_class", "booking_channel"],
)
_metrics(
    "metrics_bookings_by_flight_entity",
    """select f.route_type as flight__route_type, count(*) as m_bookings,
              count(distinct b.customer_id) as m_unique_customers
       from fct_bookings b left join fct_flights f using (flight_sk) group by all""",
    metrics=["m_bookings", "m_unique_customers"], group_by=["flight__route_type"],
)
_metrics(
    "metrics_across_models",
    """with f as (
           select date_trunc('quarter', flight_date)::date as metric_time,
                  (sum(total_revenue_usd) filter (flight_status != 'Cancelled'))::double as route_revenue,
                  sum(pax_count) / sum(seat_capacity) as load_factor
           from fct_flights group by 1
       ), b as (
           select date_trunc('quarter', booking_date)::date as metric_time,
                  count(*) filter (ancillary_revenue_usd > 0) / count(*) as ancillary_attach_rate,
                  count(distinct customer_id) as customer_count
           from fct_bookings group by 1
       ), s as (
           select date_trunc('quarter', feedback_date)::date as metric_time,
                  avg(sentiment_score) as customer_sentiment
           from fct_customer_feedback group by 1
       ), l as (
           select date_trunc('quarter', event_date)::date as metric_time,
                  sum(points_earned)::bigint as loyalty_engagement
           from fct_loyalty_events group by 1
       )
       select * from f full join b using (metric_time) full join s using (metric_time)
                       full join l using (metric_time)""",
    rounded="load_factor ancillary_attach_rate customer_sentiment", days="metric_time",
    metrics=["route_revenue", "load_factor", "ancillary_attach_rate", "customer_count",
             "customer_sentiment", "loyalty_engagement"],
    grain="quarter",
)
_metrics(
    "metrics_on_time_spine",
    """select date_trunc('month', date_day)::date as metric_time,
              sum(points)::bigint as loyalty_engagement
       from dim_date left join (select event_date, points_earned as points from fct_loyalty_events)
         on event_date = date_day
       group by 1""",
    days="metric_time", metrics=["loyalty_engagement"], grain="month", fill=True,
)


def _measures(w: Warehouse) -> DataFrame:
    """Every measure of every model, over all rows."""
    parts = []
    tables = questions(w)
    for model in MetricLayer(tables).models:
        rows = asked(tables, model.table, *[m.expr for m in model.measures])
        one = rows.agg(*[m.column().cast("double").alias(m.name) for m in model.measures])
        names = [F.struct(F.lit(model.name).alias("model"), F.lit(m.name).alias("measure"),
                          F.col(m.name).alias("value")) for m in model.measures]
        parts.append(one.select(F.explode(F.array(*names)).alias("r")).select("r.*"))
    return stack(parts)


_MEASURE_SQL = {
    ("flight", "fct_flights"): {
        "flights_scheduled": "count(*)",
        "flights_operated": "count(*) filter (not is_cancelled)",
        "flights_cancelled": "count(*) filter (is_cancelled)",
        "flights_on_time": "count(*) filter (is_on_time_15)",
        "pax_count": "sum(pax_count)",
        "seat_capacity_sum": "sum(seat_capacity)",
        "distance_km_total": "sum(distance_km)",
        "ticket_revenue_total": "sum(ticket_revenue_usd)",
        "ancillary_revenue_total": "sum(ancillary_revenue_usd)",
        "total_revenue": "sum(total_revenue_usd)",
        "total_operating_cost": "sum(total_operating_cost_usd)",
        "total_margin": "sum(flight_margin_usd)",
    },
    ("booking", "fct_bookings"): {
        "bookings_count": "count(*)",
        "flown_bookings_count": "count(*) filter (is_flown)",
        "ticket_revenue": "sum(ticket_price_usd)",
        "ancillary_revenue": "sum(ancillary_revenue_usd)",
        "total_booking_revenue": "sum(total_booking_revenue_usd)",
        "unique_customers": "count(distinct customer_id)",
        "bookings_with_ancillary": "count(*) filter (ancillary_revenue_usd > 0)",
    },
    ("feedback", "fct_customer_feedback"): {
        "feedbacks_count": "count(*)",
        "avg_sentiment_score": "avg(sentiment_score)",
        "negative_feedback_count": "count(*) filter (is_negative)",
        "positive_feedback_count": "count(*) filter (is_positive)",
    },
    ("ancillary_offer", "fct_ancillary_offers"): {
        "offers_presented": "count(*) filter (presented_flag)",
        "offers_accepted": "count(*) filter (accepted_flag)",
        "ancillary_accepted_revenue": "sum(accepted_revenue_usd)",
    },
    ("loyalty_event", "fct_loyalty_events"): {
        "events_count": "count(*)",
        "points_earned_total": "sum(points_earned)",
        "points_redeemed_total": "sum(points_redeemed)",
    },
}
_add(
    "metrics_all_measures", _measures,
    " union all ".join(
        f"select '{model}' as model, '{measure}' as measure, ({text})::double as value from {table}"
        for (model, table), texts in _MEASURE_SQL.items()
        for measure, text in texts.items()
    ),
    rounded="value",
)

# ---- reports ------------------------------------------------------------------------


def _report(name: str, sql: str, kinds: dict[str, str], **filters) -> None:
    base = name.removesuffix("_filtered").removesuffix("_uncut")
    _add(f"report_{name}", lambda w: reports.report(base, questions(w), **filters), sql, **kinds)


_REVENUE = {"rounded": "margin_pct load_factor", "money": "revenue"}
_SUM_MARGIN = "sum(margin_usd)::double / nullif(sum(revenue_usd), 0)::double"
_SUM_FILL = "sum(total_pax) / nullif(sum(total_seat_capacity), 0)"
_UPSELL_SQL = """select customer_id, customer_segment, loyalty_tier, upgrade_offers_presented,
    upgrade_offers_accepted, upgrade_acceptance_rate from ont_premium_upsell_candidate
    order by upgrade_acceptance_rate desc, customer_id limit {}"""

_report(
    "revenue_by_route",
    """select route_id, sum(revenue_usd) as revenue from int_route_monthly_perf group by 1
       order by revenue desc, route_id limit 20""",
    {"money": "revenue"},
)
_report(
    "revenue_by_route_filtered",
    """select route_id, sum(revenue_usd) as revenue from int_route_monthly_perf
       where period_month >= date '2024-03-01' and period_month < date '2025-01-01'
         and route_id in ('R001', 'R002', 'R009', 'R016')
       group by 1 order by revenue desc, route_id limit 20""",
    {"money": "revenue"},
    since=dt.date(2024, 3, 1), until=dt.date(2025, 1, 1), routes=["R001", "R002", "R009", "R016"],
)
_report(
    "route_opportunity_matrix",
    f"""select route_id, avg(load_factor) as load_factor, {_SUM_MARGIN} as margin_pct,
               sum(revenue_usd) as revenue
        from int_route_monthly_perf group by 1 order by revenue desc, route_id limit 50""",
    _REVENUE,
)
_report(
    "route_kpi_drilldown",
    f"""select route_id, period_month, sum(revenue_usd) as revenue, {_SUM_MARGIN} as margin_pct,
               {_SUM_FILL} as load_factor, avg(otp15_rate) as otp15,
               avg(cancellation_rate) as cancel_rate, sum(total_pax)::bigint as pax,
               sum(flights_scheduled)::bigint as flights
        from int_route_monthly_perf group by 1, 2 order by period_month desc, route_id limit 200""",
    {"money": "revenue", "rounded": "margin_pct load_factor otp15 cancel_rate", "days": "period_month"},
)
_report(
    "punctuality_trend",
    """select * from (
           select period_month, avg(otp15_rate) as otp15, avg(cancellation_rate) as cancel_rate
           from int_route_monthly_perf group by 1 order by 1 desc limit 50) newest order by 1""",
    {"rounded": "otp15 cancel_rate", "days": "period_month"},
)
_report(
    "yield_by_route_type",
    """select route_type, sum(total_revenue_usd)::double
              / nullif(sum(seat_capacity::bigint * distance_km), 0)::double as rask
       from fct_flights group by 1 order by rask desc nulls last, route_type limit 10""",
    {"rounded": "rask"},
)
_report(
    "disruptions_by_type",
    """select disruption_type, count(*) as disruption_count from fct_flights
       where disruption_type is not null group by 1 order by 2 desc, 1 limit 15""",
    {},
)
_report(
    "at_risk_customers",
    """select customer_id, last_booking_date, recency_days, monetary_total_usd, complaint_count,
              avg_sentiment, churn_risk_score from ont_high_value_at_risk_customer
       order by monetary_total_usd desc, customer_id limit 20""",
    {"money": "monetary_total_usd", "rounded": "avg_sentiment churn_risk_score", "days": "last_booking_date"},
)
_report(
    "complaint_heatmap",
    """select route_id, top_theme_1, avg(avg_sentiment) as avg_sentiment
       from int_route_complaint_themes group by 1, 2
       order by route_id, top_theme_1 nulls last limit 200""",
    {"rounded": "avg_sentiment"},
)
_report(
    "sentiment_trend",
    """select * from (
           select date_trunc('month', feedback_date)::date as feedback_date,
                  avg(sentiment_score) as avg_sentiment
           from fct_customer_feedback group by 1 order by 1 desc limit 50) newest order by 1""",
    {"rounded": "avg_sentiment", "days": "feedback_date"},
)
_report(
    "upgrade_conversion_by_tier",
    """select loyalty_tier, count(*) filter (accepted_flag) / count(*) filter (presented_flag)
                  as conversion_rate
       from fct_ancillary_offers
       where offer_type in ('upgrade_W', 'upgrade_J') and loyalty_tier is not null
       group by 1 order by 2 desc, 1 limit 10""",
    {"rounded": "conversion_rate"},
)
_report(
    "attach_rate_by_segment",
    """select customer_segment_at_booking, avg((ancillary_revenue_usd > 0)::int) as attach_rate
       from fct_bookings group by 1 order by 2 desc, 1 nulls last limit 10""",
    {"rounded": "attach_rate"},
)
_report(
    "revenue_per_booking_by_fare",
    """select fare_class, sum(total_booking_revenue_usd)::double / count(*) as revenue_per_pax
       from fct_bookings group by 1 order by 2 desc, 1 limit 10""",
    {"rounded": "revenue_per_pax"},
)
_report("upsell_candidates", _UPSELL_SQL.format(20), {})
_report(
    "routes_to_grow",
    f"""select route_id, sum(revenue_usd) as revenue, {_SUM_MARGIN} as margin_pct, {_SUM_FILL} as load_factor
        from int_route_monthly_perf group by 1 order by revenue desc, route_id limit 10""",
    _REVENUE,
)
_report(
    "routes_to_defend",
    """select route_id, route_type, is_strategic, total_flights_12m, cancellation_rate_12m,
              disruption_rate_12m from ont_irops_heavy_route
       order by disruption_rate_12m desc, route_id limit 20""",
    {},
)
_report(
    "customers_to_retain",
    """select customer_id, monetary_total_usd, recency_days, complaint_count, avg_sentiment, ltv_proxy_usd
       from ont_high_value_at_risk_customer order by ltv_proxy_usd desc, customer_id limit 50""",
    {"money": "monetary_total_usd", "rounded": "avg_sentiment ltv_proxy_usd"},
)
_report("offers_to_prioritise", _UPSELL_SQL.format(50), {})
_report(
    "route_kpi_drilldown_uncut",
    f"""select route_id, period_month, sum(revenue_usd) as revenue, {_SUM_MARGIN} as margin_pct,
               {_SUM_FILL} as load_factor, avg(otp15_rate) as otp15,
               avg(cancellation_rate) as cancel_rate, sum(total_pax)::bigint as pax,
               sum(flights_scheduled)::bigint as flights
        from int_route_monthly_perf group by 1, 2""",
    {"money": "revenue", "rounded": "margin_pct load_factor otp15 cancel_rate", "days": "period_month"},
    limit=None,
)
_report(
    "punctuality_trend_uncut",
    """select period_month, avg(otp15_rate) as otp15, avg(cancellation_rate) as cancel_rate
       from int_route_monthly_perf group by 1""",
    {"rounded": "otp15 cancel_rate", "days": "period_month"},
    limit=None,
)
_report(
    "complaint_heatmap_uncut",
    """select route_id, top_theme_1, avg(avg_sentiment) as avg_sentiment
       from int_route_complaint_themes group by 1, 2""",
    {"rounded": "avg_sentiment"},
    limit=None,
)
_report(
    "sentiment_trend_uncut",
    """select date_trunc('month', feedback_date)::date as feedback_date,
              avg(sentiment_score) as avg_sentiment
       from fct_customer_feedback group by 1""",
    {"rounded": "avg_sentiment", "days": "feedback_date"},
    limit=None,
)
_add(
    "report_segment_matrix",
    lambda w: reports.segment_matrix(w["dim_customer_current"]),
    """with c as (select customer_segment, loyalty_tier_safe as t from dim_customer_current),
       cells as (select customer_segment as segment, t from c union all select 'Total', t from c)
       select segment, count(*) filter (t = 'Explorer') as Explorer, count(*) filter (t = 'Silver') as Silver,
              count(*) filter (t = 'Gold') as Gold, count(*) filter (t = 'non_member') as non_member,
              count(*) as total
       from cells group by 1""",
)
_add(
    "report_points_per_member",
    lambda w: reports.points_per_member(w["fct_loyalty_events"], w.today),
    f"""select sum(points_earned) / nullif(count(distinct customer_id), 0) as points_per_member
        from fct_loyalty_events
        where event_date >= date '{TODAY}' - interval 12 month and event_date < date '{TODAY}'""",
    rounded="points_per_member",
)

# ---- lookups ------------------------------------------------------------------------

_LOOKUP = """with last as (select max(period_month) as latest from int_route_monthly_perf)
    select route_id, round(sum(revenue_usd), 0)::double as revenue_usd,
           round({margin}, 4) as margin_pct, round({fill}, 4) as load_factor,
           round(avg(otp15_rate), 4) as otp15_rate, round(avg(cancellation_rate), 4) as cancellation_rate
    from int_route_monthly_perf, last where period_month > latest - interval {months} month
    group by route_id order by revenue_usd desc nulls last, route_id limit {limit}"""
_add(
    "lookup_routes_with_kpis", lambda w: lookups.routes_with_kpis(w.written("int_route_monthly_perf")),
    _LOOKUP.format(margin=_SUM_MARGIN, fill=_SUM_FILL, months=12, limit=20),
)
_add(
    "lookup_routes_last_quarter", lambda w: lookups.routes_with_kpis(w.written("int_route_monthly_perf"), 3, 5),
    _LOOKUP.format(margin=_SUM_MARGIN, fill=_SUM_FILL, months=3, limit=5),
)
_add(
    "lookup_at_risk", lambda w: lookups.at_risk_customers(w["ont_high_value_at_risk_customer"]),
    """select customer_id, recency_days, monetary_total_usd, ltv_proxy_usd, complaint_count,
              avg_sentiment, churn_risk_score from ont_high_value_at_risk_customer
       order by ltv_proxy_usd desc, customer_id limit 20""",
    money="monetary_total_usd", rounded="ltv_proxy_usd avg_sentiment churn_risk_score",
)
_SEARCH = """select feedback_id, feedback_date, route_id, customer_id, language, sentiment_score,
    sentiment_label, complaint_category, raw_text from fct_customer_feedback {where}
    order by sentiment_score, feedback_date desc, feedback_id limit {limit}"""
_add(
    "lookup_feedback", lambda w: lookups.search_feedback(w["fct_customer_feedback"]),
    _SEARCH.format(where="", limit=10), days="feedback_date",
)
_add(
    "lookup_feedback_filtered",
    lambda w: lookups.search_feedback(w["fct_customer_feedback"], "R005", "negative", 25),
    _SEARCH.format(where="where route_id = 'R005' and sentiment_label = 'negative'", limit=25),
    days="feedback_date",
)

# ---- checks on the data -------------------------------------------------------------


def _check_sql(checks: list[quality.Check], prefix: str = "") -> str:
    rows = []
    for c in checks:
        table = prefix + c.table
        if c.rule == "not_null":
            count = f"select count(*) from {table} where {c.column} is null"
        elif c.rule == "unique":
            count = (
                f"select count(*) from (select {c.column} from {table} where {c.column} is not null "
                f"group by 1 having count(*) > 1)"
            )
        elif c.rule == "accepted_values":
            listed = ", ".join(f"'{v}'" for v in c.values)
            count = f"select count(*) from {table} where {c.column} not in ({listed})"
        elif c.rule == "range":
            count = f"select count(*) from {table} where {c.column} < {c.low} or {c.column} > {c.high}"
        else:
            parent = f"select {c.parent[1]} as k from {prefix}{c.parent[0]}"
            count = (
                f"select count(*) from {table} where {c.column} is not null "
                f"and not exists (select 1 from ({parent}) p where p.k = {table}.{c.column})"
            )
        rows.append(
            f"select '{c.table}' as \"table\", '{c.rule}' as rule, '{c.column}' as \"column\", "
            f"({count}) as violations"
        )
    return f"select *, violations = 0 as passed from ({' union all '.join(rows)})"


_add(
    "quality_sources", lambda w: quality.run_checks(w, quality.SOURCE_CHECKS),
    _check_sql(quality.SOURCE_CHECKS, "src_"),
)


def _built(w: Warehouse) -> Warehouse:
    """All tables written once, so that many checks can read them."""
    w.build(f"{shared_folder(w.spark)}/starloom/{w.spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    return w


_add(
    "quality_marts",
    lambda w: quality.run_checks(_built(w), quality.MART_CHECKS + quality.CONCEPT_CHECKS),
    _check_sql(quality.MART_CHECKS + quality.CONCEPT_CHECKS),
)
_add(
    "quality_assertions", lambda w: quality.assertions(w),
    """select 'ont_high_value_at_risk_customer' as "table", 'assertion' as rule, 'has_signal' as "column",
              count(*) as violations, count(*) = 0 as passed from ont_high_value_at_risk_customer
       where complaint_count = 0 and avg_sentiment >= 0 and churn_risk_score < 0.4::double
       union all
       select 'ont_loyal_detractor', 'assertion', 'is_gold', count(*), count(*) = 0
       from ont_loyal_detractor where loyalty_tier != 'Gold'
       union all
       select 'ont_strategic_underperforming_route', 'assertion', 'is_strategic', count(*), count(*) = 0
       from ont_strategic_underperforming_route
       where route_id not in (select route_id from dim_route where is_strategic)""",
)
_add(
    "validation_subsets", lambda w: quality.run_checks(w, quality.SUBSETS),
    _check_sql(quality.SUBSETS, "src_"),
)
_FIGURE_SQL = {
    "airports_rows": "select count(*) from src_airports",
    "routes_rows": "select count(*) from src_routes",
    "aircraft_rows": "select count(*) from src_aircraft",
    "customers_rows": "select count(*) from src_customers",
    "flights_rows": "select count(*) from src_flights",
    "bookings_rows": "select count(*) from src_bookings",
    "costs_minus_flights": "select (select count(*) from src_flight_costs) - (select count(*) from src_flights)",
    "feedback_rows": "select count(*) from src_customer_feedback",
    "mean_load_factor": "select avg(fill) from fills",
    "max_load_factor": "select max(fill) from fills",
    "cancellation_rate": "select avg((flight_status = 'Cancelled')::int) from src_flights",
    "on_time_rate": "select avg(if(delay_min <= 15, 1, 0)) from src_flights where flight_status != 'Cancelled'",
    "attach_rate": "select avg((ancillary_revenue_usd > 0)::int) from src_bookings",
    "active_customer_share": "select (select count(distinct customer_id) from src_bookings) / count(*) "
    "from src_customers",
    "french_share": "select avg((language = 'fr')::int) from src_customer_feedback where language is not null",
    "texts_missing": "select count(*) from src_customer_feedback where raw_text is null",
    "mean_text_length": "select avg(length(raw_text)) from src_customer_feedback",
}


_FIGURE_PASSES = {
    "airports_rows": "value >= 13",
    "routes_rows": "value >= 16",
    "aircraft_rows": "value = 9",
    "customers_rows": "value = 1000",
    "flights_rows": "value > 8000",
    "bookings_rows": "value > 500000",
    "costs_minus_flights": "value = 0",
    "feedback_rows": "value = 3000",
    "mean_load_factor": "value between 0.60 and 0.90",
    "max_load_factor": "value <= 1.05",
    "cancellation_rate": "value between 0.01 and 0.07",
    "on_time_rate": "value between 0.55 and 0.80",
    "attach_rate": "value between 0.70 and 0.90",
    "active_customer_share": "value between 0.70 and 0.90",
    "french_share": "value between 0.55 and 0.75",
    "texts_missing": "value = 0",
    "mean_text_length": "value > 30",
}
_add(
    "validation_figures", lambda w: quality.validation(w),
    "with fills as (select n / nullif(seat_capacity, 0) as fill from src_flights join "
    "(select flight_id, count(*) as n from src_bookings group by 1) using (flight_id)), f as ("
    + " union all ".join(f"select '{n}' as figure, ({q})::double as value" for n, q in _FIGURE_SQL.items())
    + ") select *, case figure "
    + " ".join(f"when '{n}' then {passes}" for n, passes in _FIGURE_PASSES.items())
    + " end as passed from f",
    rounded="value",
)


def _build_counts(w: Warehouse) -> DataFrame:
    tables = _built(w)
    return stack(
        [tables[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n in _BUILT]
    )


_BUILT = [
    "dim_airport", "dim_aircraft", "dim_fare", "dim_route", "dim_customer_snapshot",
    "dim_customer_current", "int_flight_full", "int_route_monthly_perf", "int_customer_rfm",
    "int_customer_lifetime", "int_feedback_tokens", "int_route_complaint_themes", "fct_flights",
    "fct_bookings", "fct_ancillary_offers", "fct_loyalty_events", "fct_customer_feedback",
    "ont_high_value_at_risk_customer", "ont_strategic_underperforming_route",
    "ont_premium_upsell_candidate", "ont_loyal_detractor", "ont_irops_heavy_route",
]
_add(
    "warehouse_build", _build_counts,
    " union all ".join(f"select '{t}' as \"table\", count(*) as n from {t}" for t in _BUILT),
)

# ---- derived operational and commercial columns -------------------------------------


def _extended_routes(w: Warehouse) -> DataFrame:
    """Operated routes plus candidates, one per competitor route, then tagged."""
    base = w["stg_routes"].drop("_loaded_at", "route_status", "is_strategic")
    extra = w["stg_competitors"].select(
        F.concat(F.lit("N"), F.col("route_id")).alias("route_id"), F.lit("candidate").alias("route_status")
    )
    both = enrich.append_rows(base, extra.distinct(), route_status="operated")
    return enrich.tag_strategic(both, ("R009", "R013", "NR014", "NR016"))


_add(
    "routes_extended", _extended_routes,
    """select *, route_id in ('R009', 'R013', 'NR014', 'NR016') as is_strategic from (
           select * exclude (route_status, is_strategic), 'operated' as route_status from stg_routes
           union all by name
           select distinct 'N' || route_id as route_id, 'candidate' as route_status from stg_competitors)""",
)
_add(
    "aircraft_capacity", lambda w: enrich.with_capacity(w["stg_aircraft"].drop("total_seats", "typed_capacity")),
    """select * exclude (total_seats, typed_capacity),
              seats_business + seats_premium_eco + seats_economy as total_seats,
              case aircraft_type when 'A319' then 122 when 'A330-900neo' then 281 else 150 end as typed_capacity
       from stg_aircraft""",
)
_add(
    "block_costs", lambda w: enrich.block_costs(w["stg_flights"]),
    """select flight_id, round_even(hours, 3) as block_hours,
              hours * case aircraft_type when 'A319' then 3400 when 'A320' then 3600 when 'A320neo' then 2900
                           when 'A330-900neo' then 7200 else 3500 end as direct_cost_usd
       from (select *, greatest(epoch(scheduled_arrival_at) - epoch(scheduled_departure_at), 1200) / 60.0::double
                       / 60.0::double as hours from stg_flights)""",
    rounded="direct_cost_usd",
)
_add(
    "cost_totals", lambda w: enrich.cost_total(w["stg_flight_costs"].drop("total_operating_cost_usd")),
    "stg_flight_costs", money="block_hours " + _COSTS,
)
_add(
    "disruption_rows", lambda w: enrich.disruption_rows(w["stg_flights"]),
    """select flight_id, case when delay_min > 180 then 'Severe' when delay_min between 0 and 60 then 'Minor'
                              else 'Major' end as severity, ifnull(delay_min, 180) as duration_min
       from stg_flights
       where flight_status = 'Cancelled' or (flight_status = 'Delayed' and (delay_min > 60
             or (delay_min >= 16 and substr(md5(flight_id), 1, 2) < '4d')))""",
)
_add(
    "weather_severity",
    lambda w: w["stg_weather_daily"].select(
        "airport_code", "weather_date",
        enrich.weather_severity(F.col("precipitation_mm"), F.col("wind_kph")).alias("severity"),
    ),
    """select airport_code, weather_date, case when precipitation_mm > 25 then 'High' when wind_kph > 40
              then 'High' when precipitation_mm > 10 or wind_kph > 30 then 'Medium' else 'Low'
              end as severity from stg_weather_daily""",
    days="weather_date",
)
_add(
    "points_earned",
    lambda w: enrich.points_earned(w["stg_bookings"], w["stg_customers"], w["stg_flights"], w["stg_routes"]),
    """select booking_id, customer_id, loyalty_tier as tier_at_event, 'earn' as event_type,
              round_even(ifnull(distance_km, 500) * case loyalty_tier when 'Gold' then 1.5
                         when 'Silver' then 1.25 else 1 end::double, 0)::int as points_delta,
              booking_date as event_date, flight_id, route_id
       from (select booking_id, customer_id, flight_id, booking_date from stg_bookings
             where booking_status = 'Flown')
       join (select customer_id, loyalty_tier from stg_customers where loyalty_tier is not null)
            using (customer_id)
       left join (select flight_id, route_id from stg_flights) using (flight_id)
       left join (select route_id, distance_km from stg_routes) using (route_id)""",
    days="event_date",
)
_add(
    "offer_chances", lambda w: enrich.offer_chances(w["stg_bookings"], w["stg_customers"]),
    """select booking_id, offer_type,
              least(base::double * case customer_segment when 'Premium' then 1.7 when 'Business' then 1.4
                                        else 1 end::double
                    * if(loyalty_tier = 'Gold', 1.3, 1)::double, 0.95::double) as acceptance
       from stg_bookings left join (select customer_id, customer_segment, loyalty_tier from stg_customers)
            using (customer_id)
       cross join (values ('seat_selection', 0.45), ('extra_bag', 0.30), ('upgrade_W', 0.10),
                          ('upgrade_J', 0.05), ('lounge_access', 0.15), ('priority_board', 0.20)) o(offer_type, base)
       where not (offer_type = 'upgrade_W' and fare_class != 'Economy')
         and not (offer_type = 'upgrade_J' and fare_class != 'Premium Economy')""",
    rounded="acceptance",
)
_add(
    "cargo_eligible_flights",
    lambda w: enrich.cargo_eligible(w["stg_flights"], w["stg_routes"]).select("flight_id", "route_id"),
    """select flight_id, route_id from stg_flights join (select route_id, distance_km from stg_routes)
              using (route_id) where distance_km > 2500 and flight_status != 'Cancelled'""",
)
_add(
    "feedback_propensity",
    lambda w: enrich.feedback_propensity(w["stg_bookings"], w["stg_disruptions"]),
    """select booking_id, flight_id, hit is not null as has_disruption,
              case when hit then 0.085 when fare_class = 'Business' then 0.025
                   else 0.018 end::double as propensity
       from stg_bookings left join (select distinct flight_id, true as hit from stg_disruptions)
            using (flight_id)
       where booking_status = 'Flown'""",
)


def _booking_shares(w: Warehouse) -> DataFrame:
    columns = ("booking_status", "fare_class", "fare_family", "booking_channel")
    return stack([enrich.shares(w["stg_bookings"], c) for c in columns])


_add(
    "booking_shares", _booking_shares,
    " union all ".join(
        f"""select '{c}' as "column", {c} as value, count(*) as n,
                   count(*) / sum(count(*)) over () as share from stg_bookings group by {c}"""
        for c in ("booking_status", "fare_class", "fare_family", "booking_channel")
    ),
    rounded="share",
)
_add(
    "load_profile", lambda w: enrich.load_profile(w["stg_bookings"], w["stg_flights"]),
    """select avg(fill) as mean, quantile_cont(fill, 0.1) as p10, quantile_cont(fill, 0.9) as p90
       from (select n / nullif(seat_capacity, 0) as fill from stg_flights join
             (select flight_id, count(*) as n from stg_bookings group by 1) using (flight_id))""",
    rounded="mean p10 p90",
)
_add(
    "booking_profile", lambda w: enrich.booking_profile(w["stg_bookings"], w["stg_customers"]),
    """select count(*) as bookings, avg(ticket_price_usd) as mean_price,
              avg((ancillary_revenue_usd > 0)::int) as attach_rate,
              count(distinct customer_id) as active_customers,
              count(distinct customer_id) / (select count(*) from stg_customers) as active_share
       from stg_bookings""",
    rounded="mean_price attach_rate active_share",
)
_add(
    "acceptance_by_type", lambda w: enrich.acceptance_by_type(w["stg_ancillary_offers"]),
    "select offer_type, avg(accepted_flag::int) as acceptance from stg_ancillary_offers group by 1",
    rounded="acceptance",
)
_add(
    "bags_one_by_one",
    lambda w: enrich.repeat_rows(w["stg_bookings"].select("booking_id", "bags_count"), "bags_count"),
    """select booking_id, bags_count, unnest(range(1, bags_count + 1))::int as copy_no from stg_bookings""",
)


# ---- facts by month, and pages on them ----------------------------------------------

_BAD_MONTH = dt.date(2024, 11, 1)


def _month_replaced(w: Warehouse) -> DataFrame:
    """Facts whose load went wrong in one month, after that month was written anew."""
    parts = []
    for fact, day in FACT_DAYS.items():
        path = f"{shared_folder(w.spark)}/starloom/{w.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
        how = FACT_COLUMNS[fact], fact not in SPREAD_FACTS
        twice = w.rows(fact).withColumn("_copy", F.explode(
            F.when(F.trunc(day, "month") == F.lit(_BAD_MONTH), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        )).drop("_copy")
        stored = write_by_month(twice, path, day, *how)
        replace_months(w.rows(fact), path, day, [_BAD_MONTH], *how)
        stored = w.spark.read.schema(stored.schema).parquet(path)
        parts.append(
            stored.groupBy(F.col("in_month").alias("month")).agg(F.count("*").alias("n_rows"))
            .select(F.lit(fact).alias("fact"), "month", "n_rows")
        )
    return stack(parts)


_add(
    "facts_month_replaced", _month_replaced,
    " union all ".join(
        f"select '{fact}' as fact, date_trunc('month', {day})::date as month, count(*) as n_rows "
        f"from {fact} group by 2"
        for fact, day in FACT_DAYS.items()
    ),
    days="month",
)


def _page(name: str, fact: str, sql_amount: str, group: str, condition: str, **filters) -> None:
    _add(
        f"page_{name}",
        lambda w: reports.page(fact, questions(w), **{k: v(w) if callable(v) else v for k, v in filters.items()}),
        f"""select date_trunc('month', {FACT_DAYS[fact]})::date as month, {group}, count(*) as n_rows,
                   sum({sql_amount})::double as amount
            from {fact} where {condition} group by 1, 2""",
        days="month",
    )


_RANGE = {"since": dt.date(2024, 3, 10), "until": dt.date(2024, 9, 20), "routes": ["R001", "R002", "R009", "R016"]}
_IN_RANGE = "{0} >= date '2024-03-10' and {0} < date '2024-09-20'"
_ON_ROUTES = " and route_id in ('R001', 'R002', 'R009', 'R016')"
_page(
    "flights", "fct_flights", "total_revenue_usd", "route_id",
    _IN_RANGE.format("flight_date") + _ON_ROUTES, **_RANGE,
)
_page(
    "bookings", "fct_bookings", "total_booking_revenue_usd", "route_id",
    _IN_RANGE.format("booking_date") + _ON_ROUTES, **_RANGE,
)
_page(
    "offers", "fct_ancillary_offers", "accepted_revenue_usd", "offer_type",
    _IN_RANGE.format("offer_date"), **_RANGE,
)
_page(
    "loyalty", "fct_loyalty_events", "points_earned", "route_id",
    _IN_RANGE.format("event_date") + _ON_ROUTES, **_RANGE,
)
_page(
    "feedback", "fct_customer_feedback", "polarised_word_count", "route_id",
    _IN_RANGE.format("feedback_date") + _ON_ROUTES, **_RANGE,
)
_page(
    "bookings_in_peak_season", "fct_bookings", "total_booking_revenue_usd", "route_id",
    """booking_date in (select date_day from dim_date where season_aviation = 'peak' and year_num = 2024)
       and route_id in ('R001', 'R002', 'R009', 'R016')""",
    routes=_RANGE["routes"],
    days=lambda w: w["dim_date"].where("season_aviation = 'peak' and year_num = 2024"),
)

# ---- joins by buckets, and histories ------------------------------------------------


def _own_folder(w: Warehouse) -> str:
    return f"{shared_folder(w.spark)}/starloom/{w.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _in_buckets(w: Warehouse, df: DataFrame, key: str) -> Bucketed:
    return write_bucketed(df, _own_folder(w), key, buckets=16)


def _bookings_by_buckets(w: Warehouse) -> DataFrame:
    bookings = _in_buckets(w, w["stg_bookings"].drop("_loaded_at"), "flight_id")
    booked = colocated_join(bookings, _in_buckets(w, w["flight_keys"], "flight_id"))
    return facts.fct_bookings_of_flights(booked, w["dim_customer_snapshot"], w["dim_customer_current"])


def _offers_by_buckets(w: Warehouse) -> DataFrame:
    offers = _in_buckets(w, w["stg_ancillary_offers"].drop("_loaded_at"), "booking_id")
    bookings = _in_buckets(w, w["stg_bookings"].select(*facts.BOOKED), "booking_id")
    return facts.fct_offers_of_bookings(colocated_join(offers, bookings, "inner"), w["dim_customer_current"])


_add(
    "fct_bookings_by_buckets", _bookings_by_buckets, "fct_bookings",
    money="ticket_price_usd ancillary_revenue_usd total_booking_revenue_usd",
    days="booking_date flight_date",
)
_add(
    "fct_ancillary_offers_by_buckets", _offers_by_buckets, "fct_ancillary_offers",
    money="offer_price_usd accepted_revenue_usd", days="offer_date", times="offer_at",
)

_THIRD_SNAPSHOT = "2025-09-01 00:00:00"


def _three_snapshots(w: Warehouse) -> DataFrame:
    store = HistoryStore(w.spark, _own_folder(w), "customer_id")
    now = w["stg_customers"].drop("_loaded_at")
    store.take(stage(w.inputs("earlier_customers"), "customers").drop("_loaded_at"), dt.datetime.fromisoformat(FIRST_SNAPSHOT))
    store.take(now, dt.datetime.fromisoformat(SECOND_SNAPSHOT))
    tier = F.when(F.col("loyalty_tier") == "Gold", "Silver").otherwise("Gold")
    moved = F.col("customer_id").endswith("4")
    later = now.withColumn("loyalty_tier", F.when(moved, tier).otherwise(F.col("loyalty_tier")))
    store.take(later, dt.datetime.fromisoformat(_THIRD_SNAPSHOT))
    return store.read().select("customer_id", "loyalty_tier", "city", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to")


_add(
    "customer_history_three_snapshots", _three_snapshots,
    f"""with moved as (
            select customer_id, if(loyalty_tier is not distinct from 'Gold', 'Silver', 'Gold') as tier_now,
                   city as city_now
            from stg_customers where customer_id like '%4'
        ), second as (
            select customer_id, loyalty_tier, city, dbt_scd_id, dbt_valid_from,
                   case when dbt_valid_to is null and tier_now is not null
                        then timestamp '{_THIRD_SNAPSHOT}' else dbt_valid_to end as dbt_valid_to
            from dim_customer_snapshot left join moved using (customer_id)
        )
        select * from second
        union all
        select customer_id, tier_now, city_now,
               md5(customer_id || '|{_THIRD_SNAPSHOT}'), timestamp '{_THIRD_SNAPSHOT}', null
        from moved""",
    times="dbt_valid_from dbt_valid_to",
)


def _long_histories(w: Warehouse) -> DataFrame:
    """Bookings against a history in which each booking day of a customer opens a version."""
    days = w["stg_bookings"].select("customer_id", F.col("booking_date").alias("day")).dropna().distinct()
    start = F.date_add("day", 3).cast("timestamp_ntz")
    history = days.select(
        "customer_id", F.date_format("day", "yyyyMMdd").alias("version"), start.alias("dbt_valid_from"),
        F.lead(start).over(Window.partitionBy("customer_id").orderBy("day")).alias("dbt_valid_to"),
    )
    return scd2.version_in_force(
        w["stg_bookings"].select("booking_id", "customer_id", "booking_date"),
        materialise(history, "history"), "customer_id", "booking_date", ["version"], most=4,
    )


_add(
    "bookings_with_long_history", _long_histories,
    """with days as (
           select distinct customer_id, booking_date as day from stg_bookings
           where customer_id is not null and booking_date is not null
       ), history as (
           select customer_id, strftime(day, '%Y%m%d') as version, day + 3 as since,
                  lead(day + 3) over (partition by customer_id order by day) as until
           from days
       )
       select b.booking_id, b.customer_id, b.booking_date, h.version as version_version
       from stg_bookings b left join history h
         on h.customer_id = b.customer_id and b.booking_date >= h.since
        and (h.until is null or b.booking_date < h.until)""",
    days="booking_date",
)

# ---- metrics by finer questions -----------------------------------------------------

_metrics(
    "metrics_by_day",
    """select flight_date as metric_time, route_type, count(*) as m_flights_scheduled,
              sum(pax_count)::bigint as m_pax
       from fct_flights group by all""",
    days="metric_time", metrics=["m_flights_scheduled", "m_pax"], group_by=["route_type"], grain="day",
)
_metrics(
    "metrics_by_week_where",
    """select date_trunc('week', booking_date)::date as metric_time, fare_class, count(*) as m_bookings,
              count(distinct customer_id) as m_unique_customers
       from fct_bookings where fare_class = 'Business' and booking_channel is not null group by 1, 2""",
    days="metric_time", metrics=["m_bookings", "m_unique_customers"], group_by=["fare_class"],
    grain="week", where="fare_class = 'Business' and booking_channel is not null",
)
_metrics(
    "metrics_by_year",
    """select date_trunc('year', flight_date)::date as metric_time,
              avg(is_cancelled::int) as cancellation_rate,
              sum(flight_margin_usd)::double / sum(total_revenue_usd)::double as route_margin_pct
       from fct_flights group by 1""",
    days="metric_time", rounded="cancellation_rate route_margin_pct",
    metrics=["cancellation_rate", "route_margin_pct"], grain="year",
)
_metrics(
    "metrics_on_spine_by_dimension",
    """with had as (
           select date_trunc('week', feedback_date)::date as metric_time, complaint_category, language,
                  avg(sentiment_score) as customer_sentiment
           from fct_customer_feedback group by 1, 2, 3
       ), ends as (
           select complaint_category, language, min(metric_time) as first, max(metric_time) as last
           from had group by 1, 2
       ), weeks as (
           select distinct date_trunc('week', date_day)::date as metric_time from dim_date
       )
       select w.metric_time, e.complaint_category, e.language, h.customer_sentiment
       from ends e join weeks w on w.metric_time between e.first and e.last
       left join had h on h.metric_time = w.metric_time
        and h.complaint_category is not distinct from e.complaint_category
        and h.language is not distinct from e.language""",
    days="metric_time", rounded="customer_sentiment", metrics=["customer_sentiment"],
    group_by=["complaint_category", "language"], grain="week", fill=True,
)


def _offer_metrics(w: Warehouse) -> DataFrame:
    layer = MetricLayer(questions(w))
    layer.metrics |= {
        m: Metric(m, "simple", measure=m) for m in ("offers_presented", "ancillary_accepted_revenue")
    }
    return layer.query(["offers_presented", "ancillary_accepted_revenue"], ["flight__route_type", "flight__route"])


_add(
    "metrics_offers_by_flight_of_booking", _offer_metrics,
    """select f.route_type as flight__route_type, f.route_sk as flight__route,
              sum(presented_flag::int)::bigint as offers_presented,
              sum(accepted_revenue_usd)::double as ancillary_accepted_revenue
       from fct_ancillary_offers o left join (select booking_id, flight_sk from fct_bookings) using (booking_id)
       left join (select flight_sk, route_type, route_sk from fct_flights) f using (flight_sk)
       group by 1, 2""",
)


def _customers_rolled_up(w: Warehouse) -> DataFrame:
    bitmaps, _ = distinct_counts.stored_bitmaps(
        asked(questions(w), "fct_bookings", "customer_id", "booking_date"), "customer_id", "booking_date"
    )
    rate = F.try_divide((F.col("n_rows") - F.col("n_distinct")).cast("double"), F.col("n_rows").cast("double"))
    return stack(
        [
            distinct_counts.distinct_by(bitmaps, grain).select(
                F.lit(grain).alias("grain"), "metric_time", F.col("n_distinct").alias("unique_customers"),
                rate.alias("repeat_booking_rate"),
            )
            for grain in ("month", "quarter", "year")
        ]
    )


_add(
    "unique_customers_rolled_up", _customers_rolled_up,
    " union all ".join(
        f"""select '{grain}' as grain, date_trunc('{grain}', booking_date)::date as metric_time,
                   count(distinct customer_id) as unique_customers,
                   (count(*) - count(distinct customer_id)) / count(*) as repeat_booking_rate
            from fct_bookings group by 2"""
        for grain in ("month", "quarter", "year")
    ),
    days="metric_time", rounded="repeat_booking_rate",
)


def _rfm_of_days(w: Warehouse) -> DataFrame:
    daily = write_by_month(cust.daily_spend(w["stg_bookings"]), _own_folder(w), "booking_date")
    return cust.rfm_base_of_days(daily)


_add("customer_rfm_base_of_days", _rfm_of_days, "rfm_base", money=_RFM_MONEY, days="last_booking_date")


def _concepts_from_file(w: Warehouse) -> DataFrame:
    """Who or what each rule of the file singles out."""
    read, tables = rule_files.read_rules(), marts(w)
    customers = tables["dim_customer_current"]
    found = [
        rules.high_value_at_risk(
            tables["int_customer_lifetime"], tables["fct_customer_feedback"], read["HighValueAtRiskCustomer"]
        ),
        rules.strategic_underperforming(
            tables["int_route_monthly_perf"], tables["dim_route"], read["StrategicUnderperformingRoute"]
        ),
        rules.premium_upsell(tables["fct_ancillary_offers"], customers, read["PremiumUpsellCandidate"]),
        rules.loyal_detractor(
            customers, tables["rfm_base"], tables["fct_customer_feedback"], read["LoyalDetractor"]
        ),
        rules.irops_heavy(tables["fct_flights"], tables["dim_route"], read["IROPSHeavyRoute"]),
    ]
    return stack([df.select("ontology_concept", F.col(df.columns[0]).alias("key")) for df in found])


_CONCEPTS = {
    "HighValueAtRiskCustomer": ("ont_high_value_at_risk_customer", "customer_id"),
    "StrategicUnderperformingRoute": ("ont_strategic_underperforming_route", "route_id"),
    "PremiumUpsellCandidate": ("ont_premium_upsell_candidate", "customer_id"),
    "LoyalDetractor": ("ont_loyal_detractor", "customer_id"),
    "IROPSHeavyRoute": ("ont_irops_heavy_route", "route_id"),
}
_add(
    "concepts_from_rule_file", _concepts_from_file,
    " union all ".join(
        f"select '{concept}' as ontology_concept, {key} as key from {table}"
        for concept, (table, key) in _CONCEPTS.items()
    ),
)

# ---- inputs by name, word lists as files, capped rows -------------------------------


def _read_back(w: Warehouse) -> DataFrame:
    """Every input, written as a file by its name and read by that name."""
    folder = _own_folder(w)
    counts = []
    for source in SOURCES:
        w[source].write.parquet(f"{folder}/{source}.parquet")
        back = stage(read_source(w.spark, folder, source), source)
        counts.append(back.agg(F.count("*").alias("n_rows")).select(F.lit(source).alias("source"), "n_rows"))
    return stack(counts)


_add(
    "sources_by_name", _read_back,
    " union all ".join(f"select '{s}' as source, count(*) as n_rows from stg_{s}" for s in SOURCES),
)


def _seed_file(w: Warehouse) -> DataFrame:
    """Polarised tokens by a word list read from a CSV file."""
    folder = _own_folder(w)
    seed_frame(w.spark, "lexicon_sentiment", BOUND_LEXICON).coalesce(1).write.csv(
        f"{folder}/lexicon_sentiment.csv", header=True
    )
    return feedback.polarised_tokens(w["int_feedback_tokens"], read_seed(w.spark, folder, "lexicon_sentiment"))


_add("polarised_tokens_from_seed_file", _seed_file, "polarised_tokens")
_CAPPED = ("booking_id", "total_booking_revenue_usd")
_add(
    "lookup_capped_rows",
    lambda w: lookups.capped_frame(
        asked(questions(w), "fct_bookings", *_CAPPED).select(*_CAPPED),
        [F.col("total_booking_revenue_usd").desc(), F.col("booking_id")],
    ),
    """select booking_id, total_booking_revenue_usd, (select count(*) > 1000 from fct_bookings) as truncated
       from fct_bookings order by total_booking_revenue_usd desc, booking_id limit 1000""",
    money="total_booking_revenue_usd",
)
