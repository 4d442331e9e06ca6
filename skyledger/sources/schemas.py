"""Declared schemas of the landed data.

Declaring them saves the extra pass of schema inference and keeps a changed file from changing
the types of the tables. All names and types below are fixed values.
"""

from __future__ import annotations

AIRLINES = "airline_code string, airline_name string, service_type string"

GATES = "gate_id string, terminal_zone string, capacity_class string"

FLIGHTS = (
    "flight_id string, airline_code string, flight_number string, direction string, "
    "origin string, destination string, traffic_type string, "
    "scheduled_time timestamp_ntz, actual_time timestamp_ntz, gate_id string, "
    "seat_capacity int, passenger_count int, status string, delay_minutes int, delay_reason string, "
    "gate_in_time timestamp_ntz, gate_out_time timestamp_ntz"
)

PASSENGER_FLOW_COLUMNS = [
    "date",
    "hour",
    "terminal_zone",
    "traffic_type",
    "passengers_processed",
    "avg_security_wait_min",
]

COMMERCIAL_COLUMNS = [
    "transaction_id",
    "timestamp",
    "revenue_category",
    "amount_cad",
    "payment_method",
    "terminal_zone",
]

TARGET_COLUMNS = [
    "kpi_name",
    "kpi_code",
    "business_area",
    "unit",
    "target_value",
    "target_direction",
    "effective_start_date",
    "effective_end_date",
]

SUSTAINABILITY_COLUMNS = [
    "date",
    "electricity_kwh",
    "water_m3",
    "waste_tonnes",
    "estimated_co2e_tonnes",
]

FEEDBACK_COLUMNS = ["feedback_id", "feedback_date", "feedback_text"]

FLIGHT_EVENTS = (
    "event_id string, "
    "flight struct<flight_id: string, flight_number: string, airline: string>, "
    "operation struct<direction: string, gate: string, status: string>, "
    "timing struct<scheduled: string, actual: string, delay: struct<minutes: int, reason: string>>, "
    "source_system string"
)

BAGGAGE_EVENTS = (
    "bag_event_id string, flight_id string, bags_processed bigint, mishandled_bags bigint, "
    "arrival struct<first_bag_min: bigint, last_bag_min: bigint>"
)
