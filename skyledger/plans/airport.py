"""The airport model: landed data to cleaned tables to a fact constellation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.clean import (
    cast_columns,
    drop_blank_text,
    fill_from_column,
    flatten_struct,
    impute_neighbour_mean,
    null_invalid_refs,
    rename_positional,
    standardize_values,
    trim_strings,
)
from skyledger.operators.dimensions import (
    calendar_attributes,
    date_spine,
    distinct_dimension,
    project_dimension,
    surrogate_key,
    union_dates,
    unknown_member,
)
from skyledger.operators.facts import (
    Lookup,
    aggregate_to_grain,
    borrow_parent_date,
    lookup_keys,
    map_unknown_key,
    with_date_key,
)
from skyledger.plans.context import Model, Relationship

# Known variants and invalid references of the landed data.
AIRLINE_VARIANTS = {"Air Canada": "AC"}
FLIGHT_TRAFFIC_VARIANTS = {"DOM": "Domestic"}
FLOW_TRAFFIC_VARIANTS = {"INTL": "International"}
CATEGORY_VARIANTS = {"F&B": "Food & Beverage"}
INVALID_GATES = ["Gate-99"]
UNKNOWN_GATE = ("dg0000", "UNKNOWN", "Unknown", "Unknown")

# Nested field -> column.
FLIGHT_EVENT_FIELDS = {
    "event_id": "event_id",
    "flight.flight_id": "flight_id",
    "flight.flight_number": "flight_number",
    "flight.airline": "airline_code",
    "operation.direction": "direction",
    "operation.gate": "gate_id",
    "operation.status": "status",
    "timing.scheduled": "scheduled_time",
    "timing.actual": "actual_time",
    "timing.delay.minutes": "delay_minutes",
    "timing.delay.reason": "delay_reason",
    "source_system": "source_system",
}
BAGGAGE_EVENT_FIELDS = {
    "bag_event_id": "bag_event_id",
    "flight_id": "flight_id",
    "bags_processed": "bags_processed",
    "mishandled_bags": "mishandled_bags",
    "arrival.first_bag_min": "first_bag_min",
    "arrival.last_bag_min": "last_bag_min",
}

# The join graph. Revenue has a zone key but no relationship to the zones.
RELATIONSHIPS = (
    Relationship("fact_passenger_flow", "date_key", "dim_date"),
    Relationship("fact_baggage_operations", "date_key", "dim_date"),
    Relationship("fact_commercial_transactions", "date_key", "dim_date"),
    Relationship("fact_flight_operations", "date_key", "dim_date"),
    Relationship("fact_passenger_flow", "terminal_zone_key", "dim_terminal_zone"),
    Relationship("fact_flight_operations", "airline_key", "dim_airline"),
    Relationship("fact_flight_operations", "gate_key", "dim_gate"),
    Relationship("fact_sustainability_daily", "date_key", "dim_date"),
    Relationship("fact_flight_operations", "flight_key", "dim_flight"),
    Relationship("fact_baggage_operations", "flight_key", "dim_flight"),
    Relationship("fact_passenger_feedback", "date_key", "dim_date"),
)
REVENUE_ZONE = Relationship("fact_commercial_transactions", "terminal_zone_key", "dim_terminal_zone")


# ---------------------------------------------------------------- cleaned tables


def clean_flights(landed: DataFrame) -> DataFrame:
    """Cancelled flights keep their null times and delays, and a missing passenger count stays missing."""
    df = standardize_values(landed, "airline_code", AIRLINE_VARIANTS)
    df = standardize_values(df, "traffic_type", FLIGHT_TRAFFIC_VARIANTS)
    return null_invalid_refs(df, "gate_id", INVALID_GATES)


def clean_passenger_flow(landed: DataFrame) -> DataFrame:
    df = standardize_values(landed, "traffic_type", FLOW_TRAFFIC_VARIANTS)
    df = fill_from_column(df, "terminal_zone", F.col("traffic_type") == "International", F.lit("International"))
    return cast_columns(
        df,
        {"date": "date", "hour": "int", "passengers_processed": "int", "avg_security_wait_min": "double"},
    )


def clean_commercial(landed: DataFrame) -> DataFrame:
    """Refunds stay negative and a missing amount stays missing."""
    df = standardize_values(landed, "revenue_category", CATEGORY_VARIANTS)
    return cast_columns(df, {"timestamp": "timestamp_ntz", "amount_cad": "double"})


def clean_targets(landed: DataFrame) -> DataFrame:
    return cast_columns(
        trim_strings(landed),
        {"target_value": "double", "effective_start_date": "date", "effective_end_date": "date"},
    )


def clean_sustainability(landed: DataFrame) -> DataFrame:
    typed = cast_columns(
        landed,
        {
            "date": "date",
            "electricity_kwh": "double",
            "water_m3": "double",
            "waste_tonnes": "double",
            "estimated_co2e_tonnes": "double",
        },
    )
    return impute_neighbour_mean(typed, ["date"], "water_m3")


def clean_flight_events(landed: DataFrame) -> DataFrame:
    df = flatten_struct(landed, FLIGHT_EVENT_FIELDS)
    df = cast_columns(df, {"scheduled_time": "timestamp_ntz", "actual_time": "timestamp_ntz"})
    df = standardize_values(df, "airline_code", AIRLINE_VARIANTS)
    return null_invalid_refs(df, "gate_id", INVALID_GATES)


def clean_baggage_events(landed: DataFrame) -> DataFrame:
    return flatten_struct(landed, BAGGAGE_EVENT_FIELDS)


def clean_feedback(landed: DataFrame) -> DataFrame:
    """An invalid date becomes null and the comment stays; blank comments are dropped."""
    df = rename_positional(landed, ["feedback_id", "feedback_date", "feedback_text"])
    return drop_blank_text(cast_columns(df, {"feedback_id": "int", "feedback_date": "date"}), "feedback_text")


def clean_tables(landed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every cleaned table that was landed, by name."""
    steps = {
        "airlines": lambda df: df,
        "gates": lambda df: df,
        "flights": clean_flights,
        "passenger_flow": clean_passenger_flow,
        "commercial_transactions": clean_commercial,
        "operational_targets": clean_targets,
        "sustainability_daily": clean_sustainability,
        "flight_operational_events": clean_flight_events,
        "baggage_events": clean_baggage_events,
        "passenger_feedback": clean_feedback,
    }
    return {name: steps[name](df) for name, df in landed.items()}


# ---------------------------------------------------------------- dimensions


def build_dim_date(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    dates = union_dates(
        [
            (cleaned["flights"], "scheduled_time"),
            (cleaned["passenger_flow"], "date"),
            (cleaned["commercial_transactions"], "timestamp"),
            (cleaned["sustainability_daily"], "date"),
            (cleaned["passenger_feedback"], "feedback_date"),
        ]
    )
    return calendar_attributes(date_spine(dates))


def build_dim_airline(airlines: DataFrame) -> DataFrame:
    keyed = surrogate_key(airlines, ["airline_code"], "da", "airline_key")
    return project_dimension(keyed, "airline_key", "airline_code", ["airline_name", "service_type"])


def build_dim_gate(gates: DataFrame) -> DataFrame:
    keyed = surrogate_key(gates, ["gate_id"], "dg", "gate_key")
    return unknown_member(
        project_dimension(keyed, "gate_key", "gate_id", ["terminal_zone", "capacity_class"]), UNKNOWN_GATE
    )


def build_dim_flight(flights: DataFrame) -> DataFrame:
    narrow = flights.select("flight_id", "flight_number", "origin", "destination")
    keyed = surrogate_key(narrow, ["flight_id"], "df", "flight_key")
    return project_dimension(keyed, "flight_key", "flight_id", ["flight_number", "origin", "destination"])


def build_dim_terminal_zone(gates: DataFrame) -> DataFrame:
    return surrogate_key(
        distinct_dimension(gates, "terminal_zone"), ["terminal_zone"], "dt", "terminal_zone_key"
    )


# ---------------------------------------------------------------- facts


def build_fact_flight(
    flights: DataFrame, dim_flight: DataFrame, dim_airline: DataFrame, dim_gate: DataFrame
) -> DataFrame:
    keyed = lookup_keys(
        flights,
        [
            Lookup(dim_flight, "flight_id", "flight_key", unique=True),
            Lookup(dim_airline, "airline_code", "airline_key"),
            Lookup(dim_gate, "gate_id", "gate_key"),
        ],
    )
    keyed = with_date_key(map_unknown_key(keyed, "gate_key", UNKNOWN_GATE[0]), "scheduled_time")
    return keyed.select(
        "flight_key",
        "date_key",
        "airline_key",
        "gate_key",
        "direction",
        "traffic_type",
        "scheduled_time",
        "actual_time",
        "seat_capacity",
        "passenger_count",
        "status",
        "delay_minutes",
        "delay_reason",
        "gate_in_time",
        "gate_out_time",
    )


def build_fact_passenger_flow(flow: DataFrame, dim_terminal_zone: DataFrame) -> DataFrame:
    grain = ["date", "hour", "terminal_zone", "traffic_type"]
    wait = (F.col("avg_security_wait_min"), F.col("passengers_processed"))
    aggregated = aggregate_to_grain(flow, grain, ["passengers_processed"], {"avg_security_wait_min": wait})
    keyed = with_date_key(surrogate_key(aggregated, grain, "pf", "passenger_flow_key"), "date")
    keyed = lookup_keys(keyed, [Lookup(dim_terminal_zone, "terminal_zone", "terminal_zone_key")])
    return keyed.select(
        "passenger_flow_key",
        "date_key",
        "terminal_zone_key",
        "hour",
        "traffic_type",
        "passengers_processed",
        "avg_security_wait_min",
    )


def build_fact_baggage(baggage: DataFrame, flights: DataFrame, dim_flight: DataFrame) -> DataFrame:
    """Date and key of the flight come through one join: flights and their dimension meet first."""
    keyed_flights = lookup_keys(
        flights.select("flight_id", "scheduled_time"),
        [Lookup(dim_flight, "flight_id", "flight_key", unique=True)],
    )
    dated = borrow_parent_date(baggage, keyed_flights, "flight_id", "scheduled_time", "flight_date", carry=["flight_key"])
    return with_date_key(dated, "flight_date").select(
        "bag_event_id",
        "flight_key",
        "date_key",
        "bags_processed",
        "mishandled_bags",
        "first_bag_min",
        "last_bag_min",
    )


def build_fact_commercial(transactions: DataFrame, dim_terminal_zone: DataFrame) -> DataFrame:
    keyed = lookup_keys(transactions, [Lookup(dim_terminal_zone, "terminal_zone", "terminal_zone_key")])
    return with_date_key(keyed, "timestamp").select(
        "transaction_id",
        "date_key",
        "terminal_zone_key",
        "timestamp",
        "revenue_category",
        "payment_method",
        "amount_cad",
    )


def build_fact_sustainability(daily: DataFrame) -> DataFrame:
    return with_date_key(daily, "date").select(
        "date_key", "electricity_kwh", "water_m3", "waste_tonnes", "estimated_co2e_tonnes"
    )


def build_fact_feedback(feedback: DataFrame) -> DataFrame:
    """Undated comments stay, with a null date key."""
    return with_date_key(feedback, "feedback_date").select("feedback_id", "date_key", "feedback_text")


def build_targets(targets: DataFrame) -> DataFrame:
    columns = [
        "kpi_name",
        "kpi_code",
        "business_area",
        "unit",
        "target_value",
        "target_direction",
        "effective_start_date",
        "effective_end_date",
    ]
    return surrogate_key(targets.select(*columns), ["kpi_name", "effective_start_date"], "ot", "target_key")


def build_model(cleaned: Mapping[str, DataFrame], revenue_by_zone: bool = False) -> Model:
    """The fact constellation over cleaned tables.

    ``revenue_by_zone`` adds the relationship of revenue to the terminal zones.
    """
    dim_date = build_dim_date(cleaned)
    dim_airline = build_dim_airline(cleaned["airlines"])
    dim_gate = build_dim_gate(cleaned["gates"])
    dim_flight = build_dim_flight(cleaned["flights"])
    dim_zone = build_dim_terminal_zone(cleaned["gates"])
    return Model(
        facts={
            "fact_flight_operations": build_fact_flight(cleaned["flights"], dim_flight, dim_airline, dim_gate),
            "fact_passenger_flow": build_fact_passenger_flow(cleaned["passenger_flow"], dim_zone),
            "fact_baggage_operations": build_fact_baggage(
                cleaned["baggage_events"], cleaned["flights"], dim_flight
            ),
            "fact_commercial_transactions": build_fact_commercial(cleaned["commercial_transactions"], dim_zone),
            "fact_sustainability_daily": build_fact_sustainability(cleaned["sustainability_daily"]),
            "fact_passenger_feedback": build_fact_feedback(cleaned["passenger_feedback"]),
        },
        dimensions={
            "dim_date": dim_date,
            "dim_airline": dim_airline,
            "dim_gate": dim_gate,
            "dim_flight": dim_flight,
            "dim_terminal_zone": dim_zone,
        },
        relationships=RELATIONSHIPS + ((REVENUE_ZONE,) if revenue_by_zone else ()),
        targets=build_targets(cleaned["operational_targets"]),
    )
