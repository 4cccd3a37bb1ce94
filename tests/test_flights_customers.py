import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import customers, flights

BOOKINGS = (
    "booking_id string, booking_date date, customer_id string, flight_id string, "
    "booking_status string, ticket_price_usd decimal(10,2), ancillary_revenue_usd decimal(10,2)"
)


def booking(i, day, who, flight, status="Flown", price="100.00", extra="10.00"):
    return (f"B{i}", dt.date.fromisoformat(day), who, flight, status, Decimal(price), Decimal(extra))


@pytest.fixture(scope="module")
def flight_rows(spark):
    plain = [
        # id, status, delay, capacity
        ("F1", "Cancelled", None, 10),
        ("F2", "On Time", None, 10),
        ("F3", "On Time", 15, 10),
        ("F4", "Delayed", 16, 0),
        ("F5", "On Time", 0, 10),
    ]
    fl = spark.createDataFrame(plain, "flight_id string, flight_status string, delay_min int, seat_capacity int")
    at = "timestamp_ntz '2024-05-01 08:00:00'"
    fl = fl.selectExpr(
        "*", "'SL1' as flight_number", "'R1' as route_id", "'T1' as tail_number", "'A320' as aircraft_type",
        "date '2024-05-01' as flight_date", f"{at} as scheduled_departure_at", f"{at} as actual_departure_at",
        f"{at} as scheduled_arrival_at", f"{at} as actual_arrival_at",
    )
    routes = spark.sql(
        "select 'R1' as route_id, 'AAA' as origin_airport_code, 'BBB' as destination_airport_code, "
        "'Domestic' as route_type, 500 as distance_km"
    )
    money = ["fuel_cost_usd", "crew_cost_usd", "airport_fees_usd", "maintenance_alloc_usd",
             "irops_penalty_usd", "total_operating_cost_usd"]
    costs = spark.sql("select 'F3' as flight_id, " + ", ".join(f"cast(50 as decimal(10,2)) as {m}" for m in money))
    sold = spark.createDataFrame(
        [
            booking(1, "2024-01-01", "C1", "F3"),
            booking(2, "2024-01-01", "C1", "F3"),
            booking(3, "2024-01-01", "C2", "F3", "No Show"),
            booking(4, "2024-01-01", "C2", "F5", price="0.00", extra="0.00"),
        ],
        BOOKINGS,
    )
    hits = spark.sql(
        "select * from values ('F1', 'ATC', 'Major', 180, 'x'), ('F5', 'Crew', 'Minor', 20, 'y'), "
        "('F5', 'Other', 'Minor', 25, 'z') as t(flight_id, disruption_type, severity, duration_min, root_cause_text)"
    )
    sky = spark.sql("select 'AAA' as airport_code, date '2024-05-01' as weather_date, 'High' as severity_flag")
    return flights.flight_full(fl, routes, costs, sold, hits, sky).cache()


def test_on_time_flag(flight_rows):
    found = {r.flight_id: r.is_on_time_15 for r in flight_rows.collect()}
    assert found == {"F1": None, "F2": False, "F3": True, "F4": False, "F5": True}


def test_margin_and_load(flight_rows):
    rows = {r.flight_id: r for r in flight_rows.collect()}
    assert rows["F3"].flight_margin_usd == Decimal("170.00")
    assert rows["F3"].flight_margin_pct == pytest.approx(170 / 220)
    assert rows["F3"].load_factor == 0.2
    assert rows["F5"].flight_margin_pct is None  # no revenue
    assert rows["F4"].load_factor is None  # no seats
    assert rows["F2"].total_revenue_usd == 0 and rows["F2"].total_operating_cost_usd is None
    assert rows["F2"].origin_weather_severity == "High"


def test_two_disruptions_give_two_rows(flight_rows):
    assert flight_rows.where("flight_id = 'F5'").count() == 2


def test_route_month(flight_rows):
    (row,) = flights.route_monthly(flight_rows.dropDuplicates(["flight_id"])).collect()
    assert (row.flights_scheduled, row.flights_cancelled, row.flights_operated) == (5, 1, 4)
    assert row.cancellation_rate == 0.2
    assert row.otp15_rate == 0.5
    assert row.period_month == dt.date(2024, 5, 1)
    assert row.load_factor == 3 / 40


def test_recency_window_edges(frame):
    rows = [
        booking(1, "2025-06-01", "now", "F"),
        booking(2, "2024-06-01", "edge", "F"),  # 365 days before
        booking(3, "2024-05-31", "past", "F"),  # 366 days before
        booking(4, "2026-01-01", "later", "F", "No Show"),  # not counted
    ]
    found = {r.customer_id: r for r in customers.rfm_base(frame(rows, BOOKINGS)).collect()}
    assert set(found) == {"now", "edge", "past"}
    assert (found["edge"].recency_days, found["edge"].frequency_12m) == (365, 1)
    assert (found["past"].recency_days, found["past"].frequency_12m) == (366, 0)
    assert found["past"].monetary_12m_usd == 0
    assert found["past"].monetary_total_usd == Decimal("110.00")


def test_offers_and_lifetime(frame):
    sold = frame([booking(1, "2025-06-01", "a", "F"), booking(2, "2023-01-01", "b", "F")], BOOKINGS)
    offers = frame([("O1", "B1", True), ("O2", "B1", False)], "ancillary_offer_id string, booking_id string, accepted_flag boolean")
    per = customers.offers_per_customer(sold, offers)
    assert {r.customer_id: (r.accepted_offers, r.presented_offers) for r in per.collect()} == {"a": (1, 2), "b": (0, 0)}
    life = {r.customer_id: r for r in customers.lifetime(customers.rfm(customers.rfm_base(sold)), per).collect()}
    assert life["a"].offer_acceptance_rate == 0.5
    assert life["b"].offer_acceptance_rate is None
    assert life["b"].churn_risk_score == 1.0  # capped
    assert life["a"].ltv_proxy_usd == 110.0


def test_quintiles_are_full(frame):
    rows = [booking(i, "2025-06-01", f"c{i}", "F", price=f"{100 + i}.00") for i in range(12)]
    scored = customers.rfm(customers.rfm_base(frame(rows, BOOKINGS)))
    sizes = {r.m_score: r["count"] for r in scored.groupBy("m_score").count().collect()}
    assert sizes == {1: 3, 2: 3, 3: 2, 4: 2, 5: 2}
    assert scored.agg(F.max("monetary_12m_percentile")).first()[0] == 1.0
