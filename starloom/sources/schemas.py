"""Column types of the fourteen inputs and the three lookup files.

Fixed values: the names and types below are the data contract of the inputs.
"""

from __future__ import annotations

import re

# source -> [(column, type, name after staging)]
_SPECS = {
    "airports": """
        airport_code string, airport_name string, city string, country string,
        timezone string, latitude double, longitude double""",
    "routes": """
        route_id string, origin_airport_code string, destination_airport_code string,
        route_type string, distance_km int, block_time_min int, route_status string,
        is_strategic boolean""",
    "aircraft": """
        tail_number string, aircraft_type string, manufacturer string, build_year int,
        seats_business int, seats_premium_eco int, seats_economy int,
        fleet_status string, total_seats int, typed_capacity int""",
    "customers": """
        customer_id string, first_name string, last_name string, gender string,
        birth_date date, country string, city string, customer_segment string,
        loyalty_tier string, signup_date date, preferred_channel string""",
    "flights": """
        flight_id string, flight_number string, route_id string, tail_number string,
        flight_date date, scheduled_departure timestamp_ntz, actual_departure timestamp_ntz,
        scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz,
        aircraft_type string, seat_capacity int, flight_status string, delay_min int""",
    "bookings": """
        booking_id string, booking_date date, customer_id string, flight_id string,
        booking_channel string, fare_class string, fare_family string,
        ticket_price_usd decimal(10,2), ancillary_revenue_usd decimal(10,2),
        bags_count int, seat_selection_flag int, booking_status string""",
    "flight_costs": """
        flight_id string, block_hours decimal(8,3), fuel_cost_usd decimal(10,2),
        crew_cost_usd decimal(10,2), airport_fees_usd decimal(10,2),
        maintenance_alloc_usd decimal(10,2), irops_penalty_usd decimal(10,2),
        total_operating_cost_usd decimal(10,2)""",
    "disruptions": """
        disruption_id string, flight_id string, disruption_type string,
        severity string, duration_min int, root_cause_text string""",
    "weather_daily": """
        airport_code string, weather_date date, precipitation_mm decimal(6,1),
        wind_kph decimal(6,1), severity_flag string""",
    "loyalty_activity": """
        loyalty_event_id string, customer_id string, tier_at_event string,
        event_type string, points_delta int, event_date timestamp_ntz,
        flight_id string, route_id string""",
    "ancillary_offers": """
        ancillary_offer_id string, booking_id string, offer_type string,
        offer_price_usd decimal(10,2), presented_flag boolean, accepted_flag boolean,
        offer_date timestamp_ntz""",
    "cargo_shipments": """
        cargo_shipment_id string, flight_id string, weight_kg decimal(10,1),
        revenue_usd decimal(10,2), cargo_type string, shipper_country string""",
    "competitors": """
        route_id string, competitor_name string, snapshot_month date,
        avg_fare_usd decimal(10,2), weekly_frequency int""",
    "customer_feedback": """
        feedback_id string, customer_id string, booking_id string, flight_id string,
        route_id string, feedback_channel string, feedback_date timestamp_ntz,
        language string, raw_text string""",
}

# Names that staging changes.
RENAMES = {
    "flights": {
        "scheduled_departure": "scheduled_departure_at",
        "actual_departure": "actual_departure_at",
        "scheduled_arrival": "scheduled_arrival_at",
        "actual_arrival": "actual_arrival_at",
    },
    "loyalty_activity": {"event_date": "event_at"},
    "ancillary_offers": {"offer_date": "offer_at"},
    "customer_feedback": {"feedback_date": "feedback_at", "language": "language_raw"},
}

SEED_SCHEMAS = {
    "lexicon_sentiment": "word string, language string, polarity int",
    "complaint_taxonomy": "category string, language string, keyword string, priority int",
    "negation_words": "word string, language string",
}


def columns(source: str) -> list[tuple[str, str]]:
    """(name, type) pairs of one input, in order."""
    items = re.split(r",\s*(?![^(]*\))", _SPECS[source].strip())  # not inside brackets
    return [tuple(item.split(None, 1)) for item in items]


def schema(source: str) -> str:
    """DDL schema string of one input."""
    return ", ".join(f"{name} {kind}" for name, kind in columns(source))


SOURCES = tuple(_SPECS)
