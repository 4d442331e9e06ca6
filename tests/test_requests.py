"""A table of requests against the same requests one by one."""

from datetime import date

import pytest

from skyledger.plans import kpi, requests
from skyledger.plans.context import Model, Relationship

SCHEMA = (
    "request_id int, period_no int, intent string, metric string, dimension string, start_date date, end_date date, size int, ascending boolean"
)
FLIGHTS = ["flight_key", "date_key", "airline_key", "gate_key", "status", "seat_capacity", "passenger_count", "delay_minutes"]


def _key(d):
    return d.year * 10000 + d.month * 100 + d.day


@pytest.fixture(scope="module")
def star(spark):
    days = [date(2024, 1, 1 + k) for k in range(12)]
    flights = [
        (f"f{k}", None if k == 7 else _key(days[k % 10]), ["a", "b", "x", None][k % 4], f"g{k % 3}", ["On Time", "Delayed"][k % 2], 10 + k, k, k % 5)
        for k in range(24)
    ]
    kinds = "flight_key string, date_key int, airline_key string, gate_key string, status string, seat_capacity int, passenger_count int, delay_minutes int"
    flow = [(_key(days[k % 11]), ["z1", "z2", None][k % 3], k % 2, 5 * k, 1.0 * k) for k in range(20)]
    sales = [(_key(days[k % 12]), 2.5 * k - 3) for k in range(15)]
    dims = {
        "dim_date": spark.createDataFrame([(_key(d), d) for d in days], "date_key int, date date"),
        "dim_airline": spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), ("c", "Gamma")], "airline_key string, airline_name string"),
        "dim_gate": spark.createDataFrame([(f"g{k}", f"G{k}") for k in range(4)], "gate_key string, gate_id string"),
        "dim_flight": spark.createDataFrame([(f"f{k}", f"F{k}") for k in range(24)], "flight_key string, flight_id string"),
        "dim_terminal_zone": spark.createDataFrame([("z1", "Z1"), ("z2", "Z2"), ("z3", "Z3")], "terminal_zone_key string, terminal_zone string"),
    }
    links = [("fact_flight_operations", k, d) for k, d in (("date_key", "dim_date"), ("airline_key", "dim_airline"), ("gate_key", "dim_gate"), ("flight_key", "dim_flight"))]
    links += [("fact_passenger_flow", "date_key", "dim_date"), ("fact_passenger_flow", "terminal_zone_key", "dim_terminal_zone")]
    links += [(f, "date_key", "dim_date") for f in ("fact_commercial_transactions", "fact_sustainability_daily", "fact_passenger_feedback", "fact_baggage_operations")]
    bags = [("f1", _key(days[1]), 5, 1, 3, 9), ("f2", None, 7, 0, 4, 8)]
    return Model(
        facts={
            "fact_flight_operations": spark.createDataFrame(flights, kinds),
            "fact_passenger_flow": spark.createDataFrame(
                flow, "date_key int, terminal_zone_key string, hour int, passengers_processed int, avg_security_wait_min double"
            ),
            "fact_commercial_transactions": spark.createDataFrame(sales, "date_key int, amount_cad double"),
            "fact_sustainability_daily": spark.createDataFrame(
                [(_key(d), 1.5, 2.0, 3.0, 4.0) for d in days],
                "date_key int, electricity_kwh double, water_m3 double, waste_tonnes double, estimated_co2e_tonnes double",
            ),
            "fact_passenger_feedback": spark.createDataFrame([(1, None), (2, _key(days[3]))], "feedback_id int, date_key int"),
            "fact_baggage_operations": spark.createDataFrame(
                bags, "flight_key string, date_key int, bags_processed int, mishandled_bags int, first_bag_min int, last_bag_min int"
            ),
        },
        dimensions=dims,
        relationships=tuple(Relationship(*link) for link in links),
    )


SPANS = [(None, None), (date(2024, 1, 2), date(2024, 1, 6)), (date(2024, 1, 5), date(2024, 1, 5)), (date(2030, 1, 1), date(2030, 2, 1))]
ASKED = [
    ("lookup", "total flights", None), ("lookup", "Revenue per Passenger", None), ("lookup", "Average Delay Minutes", "airline"),
    ("lookup", "Total Feedback", None), ("breakdown", "Load Factor %", "airline"), ("breakdown", "Total Flights", "gate"),
    ("breakdown", "Total Commercial Revenue", "airline"), ("breakdown", "Revenue per Passenger", "terminal"),
    ("breakdown", "Average Security Wait Time", "terminal zone"), ("ranking", "Average Delay Minutes", "flight"),
    ("ranking", "On-Time Performance %", "dimairline"), ("breakdown", "Energy per Passenger", "airline"), ("ranking", "Total Passengers", "gate"),
]


def _rounded(pairs):
    return sorted(((m, None if v is None else round(float(v), 9)) for m, v in pairs), key=repr)


def test_a_batch_answers_as_single_requests_do(spark, star):
    rows, want = [], {}
    for span in SPANS:
        for intent, metric, dimension in ASKED:
            k = len(rows)
            ascending = k % 2 == 0
            rows.append((k, 1, intent, metric, dimension, *span, None, ascending))
            period = kpi.Period("p", *span) if span[0] else None
            if intent == "lookup":
                found = [(None, r["value"]) for r in kpi.kpi_lookup(star, metric, period).collect()]
            elif intent == "breakdown":
                found = [(r["member"], r["value"]) for r in kpi.kpi_breakdown(star, metric, dimension, period).collect()]
            else:
                found = [(r["member"], r["value"]) for r in kpi.kpi_ranking(star, metric, dimension, 1, ascending, period).collect()]
            want[k] = _rounded(found)
    got = {k: [] for k in want}
    for r in requests.answer_requests(star, spark.createDataFrame(rows, SCHEMA)).collect():
        assert r["reason"] is None
        got[r["request_id"]].append((r["member"], r["value"]))
    assert {k: _rounded(v) for k, v in got.items()} == want


def test_reasons_and_comparisons(spark, star):
    day = date(2024, 1, 3)
    rows = [
        (1, 1, "compare", "Total Flights", None, day, day, None, None), (1, 2, "compare", "Total Flights", None, *SPANS[1], None, None),
        (2, 1, "guess", "Total Flights", None, None, None, None, None), (3, 1, "lookup", "profit", None, None, None, None, None),
        (4, 1, "breakdown", "Total Flights", "pilot", None, None, None, None), (5, 1, "lookup", "Total Flights", None, day, None, None, None),
        (6, 1, "lookup", "Total Flights", None, date(2024, 1, 9), day, None, None), (None, None, None, None, None, None, None, None, None),
    ]
    got = {(r["request_id"], r["period_no"]): (r["value"], r["reason"]) for r in requests.answer_requests(star, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {
        (1, 1): (3.0, None), (1, 2): (13.0, None), (2, 1): (None, "unsupported intent"), (3, 1): (None, "unknown metric"),
        (4, 1): (None, "unknown dimension"), (5, 1): (None, "half a period"), (6, 1): (None, "period ends before it starts"),
        (None, None): (None, "unsupported intent"),
    }


def test_no_requests(spark, star):
    assert requests.answer_requests(star, spark.createDataFrame([], SCHEMA)).collect() == []


def test_only_what_is_asked_for_is_read(spark, star):
    # Tables that no asked metric or dimension needs are not there at all.
    named = {"fact_flight_operations", "dim_date", "dim_airline"}
    facts, dimensions = ({k: v for k, v in tables.items() if k in named} for tables in (star.facts, star.dimensions))
    rows = [(1, 1, "ranking", "Total Flights", "airline", None, None, None, False), (2, 1, "lookup", "Total Flights", None, *SPANS[1], None, None)]
    asked = spark.createDataFrame(rows, SCHEMA)
    few = requests.answer_requests(Model(facts, dimensions, star.relationships), asked).collect()
    assert few and sorted(map(str, few)) == sorted(map(str, requests.answer_requests(star, asked).collect()))


def test_rankings_are_cut_by_shared_places(spark, star):
    spans = [(None, None), SPANS[1]]
    rows = [(k, 1, "ranking", "Total Flights", "airline", *spans[k % 2], 1 + k % 3, k % 4 < 2) for k in range(24)]
    rows += [(99, 1, "ranking", "Total Flights", "airline", *span, 2, False) for span in spans]
    got = {}
    for r in requests.answer_requests(star, spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["request_id"], []).append((r["member"], r["value"]))
    every = []
    for k, _, _, metric, _, *span, size, ascending in rows:
        period = kpi.Period("p", *span) if span[0] else None
        found = [(r["member"], r["value"]) for r in kpi.kpi_breakdown(star, metric, "airline", period).collect()]
        if k == 99:
            every += found
            continue
        values = sorted((v for _, v in found), reverse=not ascending)
        assert _rounded(got[k]) == _rounded([(m, v) for m, v in found if values.index(v) < size]), k
    # Two rankings with one request and period compete for its places.
    values = sorted((v for _, v in every), reverse=True)
    assert _rounded(got[99]) == _rounded([(m, v) for m, v in every if values.index(v) < 2])
