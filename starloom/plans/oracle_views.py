"""Checking SQL, written independently of the jobs, over the same tables.

Each view may use the views and tables it names; ``checking_sql`` strings the needed
ones together as common table expressions.
"""

from __future__ import annotations

import re

from starloom.operators.dimensions import COUNTRY_GROUPS
from starloom.sources.bindings import (
    BOUND_LEXICON,
    BOUND_NEGATIONS,
    BOUND_TAXONOMY,
    bound_sql,
)
from starloom.sources.schemas import RENAMES, SOURCES, columns

TODAY = "2026-06-01"
FIRST_SNAPSHOT = "2024-09-01 00:00:00"
SECOND_SNAPSHOT = "2025-05-01 00:00:00"
SEPARATOR = "[^a-zàâäéèêëîïôöùûüç]+"


def _values(rows: list[tuple], names: str) -> str:
    def text(value) -> str:
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) t({names})"


def _staged(source: str) -> str:
    names = RENAMES.get(source, {})
    casts = [
        f"cast({c} as {kind.replace('_ntz', '')}) as {names.get(c, c)}" for c, kind in columns(source)
    ]
    if source == "customer_feedback":
        casts.append("lower(raw_text) as normalised_text")
    return f"select {', '.join(casts)} from src_{source}"


def _key(*parts: str) -> str:
    texts = [f"coalesce(cast({p} as varchar), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def _names(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


VIEWS: dict[str, str] = {f"src_{s}": bound_sql(s) for s in SOURCES}
VIEWS.update({f"stg_{s}": _staged(s) for s in SOURCES})
VIEWS["src_earlier_customers"] = bound_sql("earlier_customers")
VIEWS["lexicon_sentiment"] = _values(BOUND_LEXICON, "word, language, polarity")
VIEWS["complaint_taxonomy"] = _values(BOUND_TAXONOMY, "category, language, keyword, priority")
VIEWS["negation_words"] = _values(BOUND_NEGATIONS, "word, language")

VIEWS["int_flight_passenger_count"] = """
select flight_id, count(*) as pax_flown, count(distinct customer_id) as unique_pax
from stg_bookings where booking_status = 'Flown' group by flight_id"""

VIEWS["int_flight_revenue"] = """
select flight_id, sum(ticket_price_usd) as ticket_revenue_usd,
       sum(ancillary_revenue_usd) as ancillary_revenue_usd,
       sum(ticket_price_usd) + sum(ancillary_revenue_usd) as total_revenue_usd
from stg_bookings where booking_status = 'Flown' group by all"""

VIEWS["int_flight_full"] = """
select s.*, coalesce(pax_flown, 0) as pax_count,
       coalesce(ticket_revenue_usd, 0) as ticket_revenue_usd,
       coalesce(ancillary_revenue_usd, 0) as ancillary_revenue_usd,
       earned as total_revenue_usd,
       fuel_cost_usd, crew_cost_usd, airport_fees_usd, maintenance_alloc_usd, irops_penalty_usd,
       total_operating_cost_usd,
       earned - spent as flight_margin_usd,
       case when earned > 0 then (earned - spent) / earned end as flight_margin_pct,
       case when seat_capacity > 0 then coalesce(pax_flown, 0) / seat_capacity end as load_factor,
       if(flight_status = 'Cancelled', null, coalesce(delay_min <= 15, false)) as is_on_time_15,
       disruption_type, severity as disruption_severity, duration_min as disruption_duration_min,
       root_cause_text, severity_flag as origin_weather_severity
from (
    select f.*, origin_airport_code, destination_airport_code, route_type, distance_km
    from stg_flights f left join stg_routes using (route_id)
) s
left join int_flight_passenger_count using (flight_id)
left join (select *, total_revenue_usd as earned_raw from int_flight_revenue) using (flight_id)
left join stg_flight_costs using (flight_id)
left join stg_disruptions using (flight_id)
left join stg_weather_daily w on w.airport_code = origin_airport_code and w.weather_date = flight_date
cross join lateral (
    select coalesce(earned_raw, 0) as earned, coalesce(total_operating_cost_usd, 0) as spent
) m"""

VIEWS["int_route_monthly_perf"] = """
select * exclude (punctual), revenue_usd - operating_cost_usd as margin_usd,
       case when revenue_usd > 0 then (revenue_usd - operating_cost_usd) / revenue_usd end as margin_pct,
       case when total_seat_capacity > 0 then total_pax / total_seat_capacity end as load_factor,
       flights_cancelled / flights_scheduled as cancellation_rate,
       punctual / nullif(flights_operated, 0) as otp15_rate
from (
    select route_id, cast(date_trunc('month', flight_date) as date) as period_month,
           count(*) as flights_scheduled,
           count(*) filter (flight_status = 'Cancelled') as flights_cancelled,
           count(*) filter (flight_status != 'Cancelled') as flights_operated,
           cast(sum(pax_count) as bigint) as total_pax,
           cast(sum(seat_capacity) as bigint) as total_seat_capacity,
           sum(total_revenue_usd) as revenue_usd,
           sum(total_operating_cost_usd) as operating_cost_usd,
           count(*) filter (is_on_time_15) as punctual
    from int_flight_full group by all
)"""

VIEWS["rfm_base"] = """
with kept as (
    select *, ticket_price_usd + ancillary_revenue_usd as spend, max(booking_date) over () as today
    from stg_bookings where booking_status = 'Flown' or booking_status = 'Confirmed'
)
select customer_id, max(booking_date) as last_booking_date,
       cast(any_value(today) - max(booking_date) as int) as recency_days,
       count(*) as frequency_total,
       count(*) filter (today - booking_date <= 365) as frequency_12m,
       sum(spend) as monetary_total_usd,
       coalesce(sum(spend) filter (today - booking_date <= 365), 0) as monetary_12m_usd
from kept group by customer_id"""

VIEWS["int_customer_rfm"] = """
select *, ntile(5) over (order by recency_days desc, md5(customer_id)) as r_score,
       ntile(5) over (order by frequency_12m, md5(customer_id)) as f_score,
       ntile(5) over (order by monetary_12m_usd, md5(customer_id)) as m_score,
       percent_rank() over (order by monetary_12m_usd) as monetary_12m_percentile
from rfm_base"""

VIEWS["offers_per_customer"] = """
select customer_id, count(*) filter (accepted_flag) as accepted_offers,
       count(ancillary_offer_id) as presented_offers
from stg_bookings left join stg_ancillary_offers using (booking_id) group by customer_id"""

VIEWS["int_customer_lifetime"] = """
select r.*, coalesce(accepted_offers, 0) as accepted_offers,
       coalesce(presented_offers, 0) as presented_offers,
       accepted_offers / nullif(presented_offers, 0) as offer_acceptance_rate,
       cast(monetary_total_usd as double) * (1 + ln(greatest(frequency_total, 1))) as ltv_proxy_usd,
       least(1.0::double, recency_days / 365.0::double * 0.6::double
             + if(frequency_12m = 0, 0.4, 0)::double) as churn_risk_score
from int_customer_rfm r left join offers_per_customer using (customer_id)"""

VIEWS["int_feedback_tokens"] = f"""
select feedback_id, token_position, token from (
    select feedback_id, generate_subscripts(words, 1) as token_position, unnest(words) as token
    from (select feedback_id, regexp_split_to_array(normalised_text, '{SEPARATOR}') as words
          from stg_customer_feedback)
) where token != ''"""

VIEWS["polarised_tokens"] = """
select feedback_id, token_position, token, polarity
from int_feedback_tokens join lexicon_sentiment on token = word"""

VIEWS["int_feedback_sentiment"] = """
with turned as (
    select distinct feedback_id, token_position + step as token_position
    from int_feedback_tokens cross join (values (1), (2)) s(step)
    where token in (select word from negation_words)
), summed as (
    select feedback_id, count(*) as hits,
           cast(sum(if(t.token_position is null, polarity, -polarity)) as bigint) as raw
    from polarised_tokens p left join turned t using (feedback_id, token_position)
    group by feedback_id
), scored as (
    select feedback_id, coalesce(raw, 0) as sentiment_raw, coalesce(hits, 0) as polarised_word_count,
           coalesce(raw / hits, 0) as sentiment_score
    from stg_customer_feedback left join summed using (feedback_id)
)
select *, case when sentiment_score <= -0.2::double then 'negative'
               when sentiment_score >= 0.2::double then 'positive' else 'neutral' end as sentiment_label
from scored"""

VIEWS["category_counts"] = """
select feedback_id, category, min(priority) as best_priority, count(*) as match_count
from int_feedback_tokens join complaint_taxonomy on keyword = token group by feedback_id, category"""

VIEWS["int_feedback_category"] = """
with best as (
    select feedback_id, category from category_counts
    qualify row_number() over (partition by feedback_id
                               order by match_count desc, best_priority, category) = 1
), listed as (
    select feedback_id, string_agg(category, ',' order by category) as all_categories
    from category_counts group by feedback_id
)
select feedback_id, coalesce(category, 'general') as complaint_category,
       coalesce(all_categories, '') as all_categories
from stg_customer_feedback left join best using (feedback_id) left join listed using (feedback_id)"""

VIEWS["int_feedback_tags"] = """
with tagged as (
    select feedback_id, token || if(polarity < 0, ':neg', ':pos') as tag from polarised_tokens
    union
    select feedback_id, category || ':cat' from category_counts
), listed as (
    select feedback_id, string_agg(tag, ',' order by tag) as semantic_tags from tagged group by 1
)
select feedback_id, coalesce(semantic_tags, '') as semantic_tags
from stg_customer_feedback left join listed using (feedback_id)"""

VIEWS["int_route_complaint_themes"] = """
with rows as (
    select route_id, cast(date_trunc('month', feedback_at) as date) as period_month,
           complaint_category, sentiment_score, sentiment_label
    from stg_customer_feedback join int_feedback_category using (feedback_id)
    join int_feedback_sentiment using (feedback_id)
    where route_id is not null
), themes as (
    select route_id, period_month, complaint_category, count(*) as n,
           row_number() over (partition by route_id, period_month
                              order by count(*) desc, complaint_category) as place
    from rows group by 1, 2, 3
), picked as (
    select route_id, period_month,
           any_value(complaint_category) filter (place = 1) as top_theme_1,
           any_value(n) filter (place = 1) as top_theme_1_count,
           any_value(complaint_category) filter (place = 2) as top_theme_2,
           any_value(n) filter (place = 2) as top_theme_2_count,
           any_value(complaint_category) filter (place = 3) as top_theme_3,
           any_value(n) filter (place = 3) as top_theme_3_count
    from themes group by 1, 2
), months as (
    select route_id, period_month, count(*) as feedback_count, avg(sentiment_score) as avg_sentiment,
           avg(if(sentiment_label = 'negative', 1, 0)) as negative_ratio,
           avg(if(sentiment_label = 'positive', 1, 0)) as positive_ratio
    from rows group by 1, 2
)
select * from months left join picked using (route_id, period_month)"""

VIEWS["dim_date"] = """
select d as date_day, cast(strftime(d, '%Y%m%d') as int) as date_sk,
       cast(year(d) as int) as year_num, cast(quarter(d) as int) as quarter_num,
       cast(month(d) as int) as month_num, strftime(d, '%B') as month_name,
       cast(weekofyear(d) as int) as iso_week, cast(dayofweek(d) as int) as day_of_week,
       strftime(d, '%A') as day_name, cast(day(d) as int) as day_of_month,
       dayofweek(d) in (0, 6) as is_weekend,
       case when month(d) in (7, 8, 12) then 'peak' when month(d) in (1, 6, 11) then 'shoulder'
            else 'off_peak' end as season_aviation,
       strftime(d, '%m-%d') in ('01-01', '05-01', '08-07', '11-15', '12-25') as is_holiday_ci,
       strftime(d, '%m-%d') in ('01-01', '05-01', '05-08', '07-14', '08-15', '11-01', '11-11', '12-25')
           as is_holiday_fr,
       cast(date_trunc('month', d) as date) as month_start_date,
       cast(date_trunc('quarter', d) as date) as quarter_start_date,
       cast(date_trunc('year', d) as date) as year_start_date
from (select cast(unnest(range(date '2023-01-01', date '2027-01-01', interval 1 day)) as date) as d)"""

_GROUP_CASES = " ".join(
    f"when country in ({_names(members)}) then '{name}'" for name, members in COUNTRY_GROUPS.items()
)
VIEWS["dim_airport"] = f"""
select *, {_key("airport_code")} as airport_sk, airport_code = 'ABJ' as is_hub,
       case {_GROUP_CASES} else 'Other' end as country_group
from stg_airports"""

VIEWS["dim_aircraft"] = f"""
select *, {_key("tail_number")} as aircraft_sk, 2026 - build_year as age_years,
       aircraft_type = 'A330-900neo' as is_widebody
from stg_aircraft"""

VIEWS["dim_fare"] = f"""
select {_key("fare_class", "fare_family")} as fare_sk, fare_class, fare_family,
       case fare_class when 'Economy' then 'Y' when 'Premium Economy' then 'W'
            when 'Business' then 'J' end as cabin_code,
       case fare_family when 'Flex' then 'flexible' when 'Standard' then 'standard'
            when 'Basic' then 'restrictive' end as fare_rule_band,
       fare_class in ('Business', 'Premium Economy') as is_premium_cabin
from stg_bookings group by fare_class, fare_family"""

VIEWS["dim_route"] = f"""
select r.*, {_key("r.route_id")} as route_sk, o.airport_sk as origin_airport_sk,
       d.airport_sk as destination_airport_sk,
       case when distance_km >= 3500 then 'long_haul' when distance_km >= 800 then 'medium_haul'
            else 'short_haul' end as distance_band
from stg_routes r
left join dim_airport o on o.airport_code = r.origin_airport_code
left join dim_airport d on d.airport_code = r.destination_airport_code"""

VIEWS["dim_customer_snapshot"] = f"""
with pairs as (
    select e.customer_id is not null as was, n.customer_id is not null as is_there,
           was and is_there and (
               e.loyalty_tier is distinct from n.loyalty_tier
               or e.customer_segment is distinct from n.customer_segment
               or e.preferred_channel is distinct from n.preferred_channel) as moved,
           e as old, n as new
    from src_earlier_customers e full join stg_customers n on e.customer_id = n.customer_id
), versions as (
    select unnest(old), timestamp '{FIRST_SNAPSHOT}' as dbt_valid_from,
           if(moved, timestamp '{SECOND_SNAPSHOT}', null) as dbt_valid_to from pairs where was
    union all by name
    select unnest(new), timestamp '{SECOND_SNAPSHOT}' as dbt_valid_from,
           cast(null as timestamp) as dbt_valid_to from pairs where moved or not was
)
select *, md5(customer_id || '|' || strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S')) as dbt_scd_id,
       coalesce(dbt_valid_to, dbt_valid_from) as dbt_updated_at
from versions"""

VIEWS["dim_customer_current"] = f"""
select * exclude (dbt_valid_from, dbt_valid_to, dbt_scd_id, dbt_updated_at),
       {_key("customer_id")} as customer_sk,
       ifnull(loyalty_tier, 'non_member') as loyalty_tier_safe,
       loyalty_tier is not null as is_loyalty_member,
       cast(date_diff('year', birth_date, date '{TODAY}') as int) as age_years,
       cast(date_diff('day', signup_date, date '{TODAY}') as int) as tenure_days
from dim_customer_snapshot where dbt_valid_to is null"""

VIEWS["fct_flights"] = f"""
select f.*, {_key("flight_id")} as flight_sk, route_sk, aircraft_sk,
       o.airport_sk as origin_airport_sk, d.airport_sk as destination_airport_sk,
       date_sk as flight_date_sk, flight_status = 'Cancelled' as is_cancelled,
       disruption_type is not null as has_disruption
from int_flight_full f
left join (select route_id, route_sk from dim_route) using (route_id)
left join (select tail_number, aircraft_sk from dim_aircraft) using (tail_number)
left join dim_airport o on o.airport_code = f.origin_airport_code
left join dim_airport d on d.airport_code = f.destination_airport_code
left join dim_date on date_day = flight_date"""

VIEWS["fct_bookings"] = f"""
with legs as (
    select flight_id, route_sk, route_id, tail_number, aircraft_type
    from stg_flights join (select route_id, route_sk from dim_route) using (route_id)
)
select {_key("b.booking_id")} as booking_sk, b.*,
       {_key("v.dbt_scd_id")} as customer_version_sk,
       ifnull(v.loyalty_tier, c.loyalty_tier) as loyalty_tier_at_booking,
       ifnull(v.customer_segment, c.customer_segment) as customer_segment_at_booking,
       flight_sk, legs.route_sk, legs.route_id, legs.tail_number, legs.aircraft_type,
       fare_sk, is_premium_cabin, date_sk as booking_date_sk, flight_date_sk, flight_date,
       ticket_price_usd + ancillary_revenue_usd as total_booking_revenue_usd,
       booking_status = 'Flown' as is_flown
from stg_bookings b
left join dim_customer_snapshot v on v.customer_id = b.customer_id
     and b.booking_date >= v.dbt_valid_from::date
     and b.booking_date < coalesce(v.dbt_valid_to::date, date '9999-12-31')
left join dim_customer_current c on c.customer_id = b.customer_id
left join legs using (flight_id)
left join (select flight_id, flight_sk, flight_date, flight_date_sk from fct_flights) using (flight_id)
left join dim_fare using (fare_class, fare_family)
left join dim_date on date_day = booking_date"""

VIEWS["fct_ancillary_offers"] = f"""
select {_key("ancillary_offer_id")} as ancillary_offer_sk, o.*, customer_sk, customer_id,
       customer_segment, loyalty_tier, flight_id, fare_sk, fare_class, fare_family,
       date_sk as offer_date_sk, offer_at::date as offer_date,
       if(accepted_flag, offer_price_usd, 0) as accepted_revenue_usd
from stg_ancillary_offers o
join (select booking_id, customer_id, flight_id, fare_class, fare_family from stg_bookings) using (booking_id)
left join (select customer_id, customer_sk, customer_segment, loyalty_tier from dim_customer_current)
    using (customer_id)
left join (select fare_sk, fare_class, fare_family from dim_fare) using (fare_class, fare_family)
left join dim_date on date_day = offer_at::date"""

VIEWS["fct_loyalty_events"] = f"""
select {_key("loyalty_event_id")} as loyalty_event_sk, e.*, customer_sk, route_sk,
       if(event_type = 'earn', points_delta, 0) as points_earned,
       if(event_type = 'redeem', -points_delta, 0) as points_redeemed,
       date_sk as event_date_sk, event_at::date as event_date
from stg_loyalty_activity e
left join (select customer_id, customer_sk from dim_customer_current) using (customer_id)
left join (select route_id, route_sk from dim_route) using (route_id)
left join dim_date on date_day = event_at::date"""

VIEWS["fct_customer_feedback"] = f"""
select {_key("f.feedback_id")} as feedback_sk, f.* exclude (language_raw, normalised_text),
       language_raw as language, customer_sk, route_sk, flight_sk, date_sk as feedback_date_sk,
       feedback_at::date as feedback_date, sentiment_score, sentiment_label, polarised_word_count,
       complaint_category, all_categories, semantic_tags,
       sentiment_label = 'negative' as is_negative, sentiment_label = 'positive' as is_positive
from stg_customer_feedback f
left join int_feedback_sentiment using (feedback_id)
left join int_feedback_category using (feedback_id)
left join int_feedback_tags using (feedback_id)
left join (select customer_id, customer_sk from dim_customer_current) using (customer_id)
left join (select route_id, route_sk from dim_route) using (route_id)
left join (select flight_id, {_key("flight_id")} as flight_sk from stg_flights) using (flight_id)
left join dim_date on date_day = feedback_at::date"""

VIEWS["ont_high_value_at_risk_customer"] = """
with mood as (
    select customer_id, count(*) filter (is_negative) as complaints, avg(sentiment_score) as feeling
    from fct_customer_feedback group by 1
)
select customer_id, last_booking_date, recency_days,
       percent_rank() over (order by recency_days) as recency_percentile, frequency_12m,
       monetary_total_usd, percent_rank() over (order by monetary_total_usd) as monetary_total_percentile,
       monetary_12m_usd, monetary_12m_percentile, ltv_proxy_usd, churn_risk_score,
       ifnull(complaints, 0) as complaint_count, ifnull(feeling, 0) as avg_sentiment,
       'HighValueAtRiskCustomer' as ontology_concept
from int_customer_lifetime left join mood using (customer_id)
qualify least(monetary_total_percentile, recency_percentile) >= 0.6::double
    and (complaint_count > 0 or avg_sentiment < 0 or churn_risk_score >= 0.4::double)"""

VIEWS["ont_strategic_underperforming_route"] = """
with span as (select max(period_month) - interval 12 month as first_month from int_route_monthly_perf),
year as (
    select route_id, cast(sum(flights_operated) as bigint) as flights_operated_12m,
           sum(revenue_usd) as revenue_12m, sum(operating_cost_usd) as cost_12m,
           sum(margin_usd) as margin_12m_usd,
           case when sum(revenue_usd) > 0
                then (sum(revenue_usd) - sum(operating_cost_usd)) / sum(revenue_usd) end as margin_pct_12m,
           case when sum(total_seat_capacity) > 0
                then sum(total_pax) / sum(total_seat_capacity) end as load_factor_12m,
           avg(cancellation_rate) as avg_cancellation_rate, avg(otp15_rate) as avg_otp15
    from int_route_monthly_perf, span where period_month >= first_month group by route_id
)
select route_id, route_type, distance_band, year.* exclude (route_id),
       percent_rank() over (order by margin_pct_12m asc nulls last) as margin_percentile_among_strategic,
       'StrategicUnderperformingRoute' as ontology_concept
from year join (select route_id, route_type, distance_band from dim_route where is_strategic) using (route_id)
qualify margin_percentile_among_strategic <= 0.5::double and load_factor_12m >= 0.65::double"""

VIEWS["ont_premium_upsell_candidate"] = """
with tried as (
    select customer_id, any_value(customer_segment) as customer_segment,
           any_value(loyalty_tier) as loyalty_tier,
           count(*) filter (presented_flag) as upgrade_offers_presented,
           count(*) filter (accepted_flag) as upgrade_offers_accepted
    from fct_ancillary_offers
    where offer_type in ('upgrade_W', 'upgrade_J') and customer_segment in ('Standard', 'Business')
      and loyalty_tier in ('Silver', 'Gold')
    group by customer_id
), rated as (
    select *, ifnull(upgrade_offers_accepted / nullif(upgrade_offers_presented, 0), 0)
                  as upgrade_acceptance_rate from tried
)
select *, percent_rank() over (order by upgrade_acceptance_rate) as acceptance_percentile,
       'PremiumUpsellCandidate' as ontology_concept
from rated qualify acceptance_percentile >= 0.75::double and upgrade_offers_presented >= 2"""

VIEWS["ont_loyal_detractor"] = """
with recent as (
    select customer_id, count(*) as feedback_count_6m, avg(sentiment_score) as avg_sentiment_6m,
           count(*) filter (is_negative) as negative_count_6m
    from fct_customer_feedback
    where feedback_date >= (select max(feedback_date) - 180 from fct_customer_feedback)
    group by customer_id
)
select customer_id, customer_segment, loyalty_tier, frequency_12m, feedback_count_6m,
       avg_sentiment_6m, negative_count_6m, 'LoyalDetractor' as ontology_concept
from dim_customer_current join rfm_base using (customer_id) join recent using (customer_id)
where loyalty_tier = 'Gold' and frequency_12m >= 4 and avg_sentiment_6m < -0.3::double"""

VIEWS["ont_irops_heavy_route"] = """
with year as (
    select route_id, count(*) as total_flights_12m, count(*) filter (is_cancelled) as cancellations_12m,
           count(*) filter (has_disruption) as disruptions_12m,
           cancellations_12m / total_flights_12m as cancellation_rate_12m,
           disruptions_12m / total_flights_12m as disruption_rate_12m
    from fct_flights
    where flight_date >= (select max(flight_date) - interval 12 month from fct_flights)
    group by route_id
), ranked as (
    select *, percent_rank() over (order by disruption_rate_12m) as disruption_percentile from year
)
select route_id, route_type, distance_band, is_strategic, ranked.* exclude (route_id),
       'IROPSHeavyRoute' as ontology_concept
from ranked join dim_route using (route_id)
where disruption_percentile >= 0.8::double or cancellation_rate_12m > 0.05::double"""


def checking_sql(body: str) -> str:
    """``body`` with every view it needs, directly or not, in front."""
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in re.findall(r"\b[a-z]\w+\b", text):
            if name in VIEWS and name != own and name not in order:
                need(VIEWS[name], name)
                order.append(name)

    need(body)
    if not order:
        return body
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in order) + "\n" + body
