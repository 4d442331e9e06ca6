"""The whole airport model on small landed files: sources, cleaning, facts, measures, KPI requests, what-ifs."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyledger import sources
from skyledger.plans import airport, dashboard, kpi, scenario
from skyledger.plans.context import filter_date_between, filter_in_list
from skyledger.plans.measures import MEASURES, evaluate
from skyledger.plans.targets import target_asof, target_status, target_variance
from skyledger.sources import schemas

FLOW = """date,hour,terminal_zone,traffic_type,passengers_processed,avg_security_wait_min
2026-08-01,7,Domestic,Domestic,212.0,6
2026-08-01,7,International,International,0.0,21
2026-08-01,14,International,International,,9
2026-08-02,14,,INTL,30.0,11
2026-08-02,14,International,International,50.0,4
"""
COMMERCIAL = """transaction_id,timestamp,revenue_category,amount_cad,payment_method,terminal_zone
X901,2026-08-12 08:30:00,Ground Transportation,31.50,Card,Transborder
X902,2026-08-05 17:05:00,Retail,-4.25,Cash,International
X903,2026-09-14 06:20:00,F&B,22.10,Mobile,International
X904,2026-09-03 12:00:00,Parking,,Card,Transborder
"""
TARGETS = """kpi_name,kpi_code,business_area,unit,target_value,target_direction,effective_start_date,effective_end_date
On-Time Performance,ON_TIME_PERFORMANCE, Operational,%,0.8,>=,2026-01-01,
Average Delay Minutes,AVG_DELAY,Operational,minutes,12.0,<=,2026-01-01,
Average Delay Minutes,AVG_DELAY,Operational,minutes,22.0,<=,2026-08-01,2026-08-05
Energy per Passenger,ENERGY_PER_PASSENGER,Sustainability,kWh,6.5,<=,2026-01-01,
Passenger Satisfaction,PASS_SATIS,Passenger Experience,score/5,3.9,>=,2026-01-01,


"""
SUSTAINABILITY = """date,electricity_kwh,water_m3,waste_tonnes,estimated_co2e_tonnes
2026-08-08,100.5,310.0,9.1,5.0
2026-08-09,200.5,,8.2,6.1
2026-08-10,300.5,350.5,7.3,4.4
2026-08-11,1.0,,1.0,1.0
"""
FEEDBACK = """007|2026-08-31|Queues at the checkpoint moved slowly.
190|no-date|Friendly staff, late suitcases.
191|2026-08-30|   
192|2026-08-30|Lovely café
"""


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")

    def write(name, text):
        path = folder / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    def at(day, hour=9):
        return datetime(2026, 8, day, hour)

    flights = [
        ("F1", "AC", "AC1", "Arrival", "YYZ", "YOW", "DOM", at(1), at(1), "G1", 100, 90, "On Time", 0, None, at(1), at(1)),
        ("F2", "Air Canada", "AC2", "Departure", "YOW", "YYZ", "Domestic", at(2), at(2, 12), "Gate-99", 100, None,
         "Delayed", 150, "Weather", at(2), at(2)),
        ("F3", "WS", "WS3", "Arrival", "JFK", "YOW", "Transborder", at(2), None, "G2", 50, 40, "Cancelled", None, None,
         None, None),
    ]
    events = [
        {"event_id": "E1", "flight": {"flight_id": "F1", "flight_number": "AC1", "airline": "Air Canada"},
         "operation": {"direction": "Arrival", "gate": "Gate-99", "status": "On Time"},
         "timing": {"scheduled": "2026-08-01 09:00:00", "actual": None, "delay": {"minutes": 3, "reason": "x"}},
         "source_system": "ops"}
    ]
    bags = [
        {"bag_event_id": "B1", "flight_id": "F1", "bags_processed": 100, "mishandled_bags": 2,
         "arrival": {"first_bag_min": 10, "last_bag_min": 25}},
        {"bag_event_id": "B2", "flight_id": "F9", "bags_processed": 50, "mishandled_bags": 1,
         "arrival": {"first_bag_min": 12, "last_bag_min": 30}},
    ]
    return {
        "airlines": sources.literal_rows(
            spark, [("AC", "Air Canada", "Passenger"), ("WS", "WestJet", "Passenger"), ("PD", "Porter", "Passenger")],
            schemas.AIRLINES,
        ),
        "gates": sources.literal_rows(
            spark, [("G1", "Domestic", "Narrow-body"), ("G2", "International", "Wide-body")], schemas.GATES
        ),
        "flights": sources.literal_rows(spark, flights, schemas.FLIGHTS),
        "passenger_flow": sources.scan_csv_strings(spark, write("flow.csv", FLOW), schemas.PASSENGER_FLOW_COLUMNS),
        "commercial_transactions": sources.scan_csv_strings(
            spark, write("sales.csv", COMMERCIAL), schemas.COMMERCIAL_COLUMNS
        ),
        "operational_targets": sources.scan_csv_strings(spark, write("goals.csv", TARGETS), schemas.TARGET_COLUMNS),
        "sustainability_daily": sources.scan_csv_strings(
            spark, write("days.csv", SUSTAINABILITY), schemas.SUSTAINABILITY_COLUMNS
        ),
        "flight_operational_events": sources.scan_json_nested(
            spark, write("events.json", json.dumps(events)), schemas.FLIGHT_EVENTS, array=True
        ),
        "baggage_events": sources.scan_json_nested(
            spark, write("bags.json", "\n".join(json.dumps(row) for row in bags)), schemas.BAGGAGE_EVENTS
        ),
        "passenger_feedback": sources.scan_delimited_noheader(
            spark, write("feedback.txt", FEEDBACK), schemas.FEEDBACK_COLUMNS
        ),
    }


@pytest.fixture(scope="module")
def cleaned(landed):
    return airport.clean_tables(landed)


@pytest.fixture(scope="module")
def model(cleaned):
    return airport.build_model(cleaned)


def rows(df, *columns):
    return [tuple(row) for row in df.select(*columns).orderBy(*columns).collect()]


def test_flights_are_standardised_and_keep_nulls(cleaned):
    result = rows(cleaned["flights"], "flight_id", "airline_code", "traffic_type", "gate_id", "passenger_count")
    assert result == [
        ("F1", "AC", "Domestic", "G1", 90),
        ("F2", "AC", "Domestic", None, None),
        ("F3", "WS", "Transborder", "G2", 40),
    ]


def test_water_is_imputed_only_between_values(cleaned):
    assert [row["water_m3"] for row in cleaned["sustainability_daily"].orderBy("date").collect()] == [
        310.0,
        pytest.approx(330.25),
        350.5,
        None,
    ]


def test_feedback_keeps_undated_and_drops_blank(cleaned):
    assert rows(cleaned["passenger_feedback"], "feedback_id", "feedback_date") == [
        (7, date(2026, 8, 31)),
        (190, None),
        (192, date(2026, 8, 30)),
    ]


def test_events_are_flattened(cleaned):
    event = cleaned["flight_operational_events"].first()
    assert (event["airline_code"], event["gate_id"], event["actual_time"], event["delay_minutes"]) == ("AC", None, None, 3)


def test_targets_are_trimmed(cleaned):
    assert {row["business_area"] for row in cleaned["operational_targets"].collect()} >= {"Operational"}
    assert cleaned["operational_targets"].count() == 5


def test_flow_fact_merges_the_repaired_rows(model):
    fact = model.facts["fact_passenger_flow"]
    merged = fact.filter("date_key = 20260802").collect()
    assert len(merged) == 1
    assert merged[0]["passengers_processed"] == 80
    assert merged[0]["avg_security_wait_min"] == pytest.approx((30 * 11 + 50 * 4) / 80)
    assert fact.filter("passengers_processed = 0").first()["avg_security_wait_min"] is None
    assert fact.count() == 4


def test_unmatched_keys(model):
    flights = model.facts["fact_flight_operations"]
    assert rows(flights, "flight_key", "gate_key") == [("df0001", "dg0001"), ("df0002", "dg0000"), ("df0003", "dg0002")]
    assert rows(model.facts["fact_baggage_operations"], "bag_event_id", "flight_key", "date_key") == [
        ("B1", "df0001", 20260801),
        ("B2", None, None),
    ]


def test_calendar_covers_every_date(model):
    bounds = model.dimensions["dim_date"].agg(F.min("date"), F.max("date"), F.count(F.lit(1))).first()
    assert tuple(bounds) == (date(2026, 8, 1), date(2026, 9, 14), 45)
    week = model.dimensions["dim_date"].filter("date_key = 20260801").first()
    assert (week["day_name"], week["week_of_year"], week["is_weekend"]) == ("Saturday", 31, True)


def test_all_measures(model):
    assert len(MEASURES) == 55
    result = evaluate(model, list(MEASURES)).collect()
    assert len(result) == 1
    row = result[0].asDict()
    assert row["Total Flights"] == 3 and row["On-Time Performance %"] == pytest.approx(1 / 3)
    assert row["Load Factor %"] == pytest.approx(130 / 250)
    assert row["Total Passengers Processed"] == 292
    assert row["Average Passengers per Hour"] == pytest.approx((212 + 80) / 2)
    assert row["Average Transaction Value"] == pytest.approx((31.5 - 4.25 + 22.1) / 3)
    assert (row["Refund Adjustment Amount"], row["Refund Adjustment Transactions"]) == (-4.25, 1)
    assert (row["Total Feedback"], row["Undated Feedback"]) == (3, 1)
    assert row["Energy per Passenger"] == pytest.approx(602.5 / 292)
    assert row["Energy per Passenger Target Status"] == "Met"
    assert row["Average Delay Target"] == 12.0 and row["Average Delay Target Status"] == "Not Met"
    assert row["Security Wait Time Target"] is None and row["Security Wait Time Target Status"] is None


def test_filter_reaches_related_facts_only(model):
    august = filter_date_between("dim_date", "date", date(2026, 8, 1), date(2026, 9, 1))
    domestic = filter_in_list("dim_terminal_zone", "terminal_zone", ["Domestic"])
    row = evaluate(
        model, ["Total Transactions", "Total Passengers Processed", "Total Feedback"], filters=[august, domestic]
    ).first()
    assert tuple(row) == (2, 212, 2)


def test_blank_group_and_members_without_facts(model):
    by_date = {r["date"]: r["Total Feedback"] for r in dashboard.trend_by_date(model, ["Total Feedback"]).collect()}
    assert by_date == {None: 1, date(2026, 8, 30): 1, date(2026, 8, 31): 1}
    rate = dashboard.breakdown_by_attribute(model, dashboard.AIRLINE, ["Load Factor %"])
    assert {r["airline_name"]: r["Load Factor %"] for r in rate.collect()} == {
        "Air Canada": 0.45,
        "WestJet": 0.8,
        "Porter": 0.0,
    }


def test_kpi_requests(model):
    august = kpi.Period("August 2026", date(2026, 8, 1), date(2026, 8, 31))
    september = kpi.Period("September 2026", date(2026, 9, 1), date(2026, 9, 30))
    later = kpi.Period("May 2030", date(2030, 5, 1), date(2030, 5, 31))
    assert kpi.kpi_lookup(model, "total commercial revenue", august).first()["value"] == pytest.approx(27.25)
    compared = kpi.kpi_compare(model, "Total Commercial Revenue", [august, september, later])
    assert [r["value"] for r in compared.orderBy("period_no").collect()] == [pytest.approx(27.25), 22.1, None]
    ratio = kpi.kpi_compare(model, "Load Factor %", [august, later])
    assert [r["value"] for r in ratio.orderBy("period_no").collect()] == [pytest.approx(0.52), 0.0]
    top = kpi.kpi_query(model, "ranking", "Load Factor %", "airline")
    assert [tuple(r) for r in top.collect()] == [("WestJet", 0.8)]
    with pytest.raises(ValueError):
        kpi.kpi_compare(model, "Total Flights", [august])
    with pytest.raises(ValueError):
        kpi.kpi_lookup(model, "Profit")
    with pytest.raises(ValueError):
        kpi.kpi_breakdown(model, "Total Flights", "pilot")


def test_target_in_force(model, spark):
    days = spark.createDataFrame([(date(2026, 8, 3),), (date(2026, 8, 6),), (date(2025, 1, 1),)], "d date")
    delays = target_asof(days, "d", model.targets, ["AVG_DELAY"])
    assert {r["d"]: r["target_value"] for r in delays.collect()} == {date(2026, 8, 3): 22.0, date(2026, 8, 6): 12.0}


def test_blank_status(spark):
    df = spark.createDataFrame([(None, 15.0)], "a double, t double")
    plain = df.select(target_status(F.col("a"), F.col("t"), "<=").alias("s"), target_variance(F.col("a"), F.col("t")).alias("v"))
    assert tuple(plain.first()) == (None, None)
    zero = df.select(
        target_status(F.col("a"), F.col("t"), "<=", True).alias("low"),
        target_status(F.col("a"), F.col("t"), ">=", True).alias("high"),
        target_variance(F.col("a"), F.col("t"), True).alias("v"),
    )
    assert tuple(zero.first()) == ("Met", "Not Met", -15.0)


def _assume(spark, *items):
    schema = "request_id int, label string, operation string, value double, period string"
    return spark.createDataFrame([(*item, "August 2026") for item in items], schema)


def test_projections(spark):
    base = spark.createDataFrame(
        [
            ("Total Passengers Processed", "August 2026", 320000.0),
            ("Total Commercial Revenue", "August 2026", 5200.40),
            ("Total Electricity Consumption", "August 2026", 1500000.50),
            ("On-Time Performance %", "August 2026", 0.55),
            ("Total Waste Generated", "August 2026", 0.0),
        ],
        "metric string, period string, value double",
    )
    asked = _assume(
        spark,
        (1, "passenger traffic", "percentage_change", 15.0),
        (2, "Commercial revenue", "percentage_change", 10.0),
        (3, "electricity", "percentage_change", -12.0),
        (4, "OTP", "percentage_point_change", 5.0),
        (5, "waste generated", "absolute_change", 3.0),
        (6, "waste generated", "absolute_change", -3.0),
        (7, "otp", "set_target", 120.0),
        (8, "load factor", "percentage_change", 1.0),
    )
    accepted, rejected = scenario.split_requests(scenario.validate_assumptions(asked))
    assert rejected.count() == 0
    result = {r["request_id"]: r for r in scenario.run_scenarios(accepted, base).collect()}
    assert result[1]["projected"] == pytest.approx(368000, rel=1e-12)
    assert result[2]["projected"] == pytest.approx(5720.44, abs=0.005)
    assert result[3]["projected"] == pytest.approx(1320000.44, abs=0.005)
    assert result[4]["projected"] == pytest.approx(0.60)
    assert result[5]["relative_change_percent"] is None and result[5]["absolute_change"] == 3.0
    assert result[6]["reject_reason"] == "projected value is negative"
    assert result[7]["reject_reason"] == "projected rate is outside 0 to 1"
    assert result[8]["reject_reason"] == "missing baseline"


def test_rejected_requests(spark):
    six = ["otp", "load factor", "electricity", "baggage volume", "first bag time", "last bag time"]
    asked = _assume(
        spark,
        *[(1, label, "percentage_change", 1.0) for label in six],
        (2, "otp", "percentage_change", 1.0),
        (2, "On-Time Performance %", "percentage_change", 2.0),
        (3, "profit", "percentage_change", 1.0),
        (4, "electricity", "percentage_point_change", 1.0),
        (5, "otp", "absolute_change", 1.0),
        (6, "otp", "percentage_change", float("nan")),
        (7, "otp", "double", 1.0),
    )
    verdict = {r["request_id"]: r["request_reason"] for r in scenario.validate_assumptions(asked).collect()}
    assert verdict[1] == "more than five assumptions"
    assert verdict[2] == "several adjustments of one metric"
    assert all(verdict[i] == "invalid assumption" for i in range(3, 8))


def test_aliases_name_one_metric(spark):
    assert kpi.alias_conflicts(kpi.alias_rows(spark)).count() == 0
    assert kpi.registry_rows(spark).count() == 21


def test_every_visual_runs(model):
    for item in dashboard.VISUALS:
        assert dashboard.run_visual(model, item).count() >= 0
    assert len(dashboard.PAGES) == 7
