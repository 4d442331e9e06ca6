"""Periods rolled up from daily states against the same measures evaluated on rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.plans import daily, kpi, scenario
from skyledger.plans.context import Model, Relationship, filter_in_list
from skyledger.plans.measures import MEASURES

DAY = date(2024, 1, 1)
METRICS = [
    "Total Commercial Revenue", "Total Transactions", "Average Transaction Value", "Refund Adjustment Amount",
    "Refund Adjustment Rate %", "Total Passengers Processed", "Average Security Wait Time", "Maximum Security Wait Time",
    "Average Passengers per Hour", "Revenue per Passenger",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _key(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(8)
    days = [DAY + timedelta(days=k) for k in range(200) if k % 17 != 3]
    keys = [None, 19990101] + [_key(d) for d in days]
    sales = [(rng.choice(keys), rng.choice([None, -3.5, 2.0, 10.25])) for _ in range(900)]
    flow = [(rng.choice(keys), rng.randint(0, 4), rng.choice([None, 0, 5, 12]), rng.choice([None, 1.5, 9.0])) for _ in range(900)]
    calendar = spark.createDataFrame([(_key(d), d) for d in days], "date_key int, date date")
    return Model(
        facts={
            "fact_commercial_transactions": spark.createDataFrame(sales, "date_key int, amount_cad double"),
            "fact_passenger_flow": spark.createDataFrame(flow, "date_key int, hour int, passengers_processed int, avg_security_wait_min double"),
        },
        dimensions={"dim_date": calendar},
        relationships=tuple(Relationship(f, "date_key", "dim_date") for f in ("fact_commercial_transactions", "fact_passenger_flow")),
    )


@pytest.fixture
def periods(spark):
    spans = [(0, 0), (0, 199), (5, 40), (20, 60), (3, 3), (-50, 10), (150, 900), (-90, -80), (33, 33), (64, 127), (40, 20)]
    rows = [(k, f"p{k}", DAY + timedelta(days=a), DAY + timedelta(days=b)) for k, (a, b) in enumerate(spans[:-1])]
    return spark.createDataFrame(rows, "period_no int, label string, start_date date, end_date date")


def _values(df):
    return {(r["label"], r["measure"]): None if r["value"] is None else round(r["value"], 9) for r in df.collect()}


@pytest.mark.parametrize("filtered", [False, True])
def test_periods_equal_rows_joined_to_their_days(star, periods, monkeypatch, filtered):
    filters = [filter_in_list("fact_commercial_transactions", "amount_cad", [2.0, -3.5])] if filtered else []
    got = _values(kpi.kpi_by_period(star, METRICS, periods, filters))
    monkeypatch.setattr(daily, "can_roll_up", lambda *_: False)
    want = _values(kpi.kpi_by_period(star, METRICS, periods, filters))
    assert got == want and len(got) == 10 * len(METRICS)
    assert any(v is None for v in got.values()) and any(v for v in got.values())


def test_overall_and_periods_of_scenarios_share_one_scan(star, periods, monkeypatch):
    got = {(r["metric"], r["period"]): r["value"] for r in scenario.scenario_baselines(star, METRICS, periods).collect()}
    monkeypatch.setattr(daily, "can_roll_up", lambda *_: False)
    want = {(r["metric"], r["period"]): r["value"] for r in scenario.scenario_baselines(star, METRICS, periods).collect()}
    assert {k: v if v is None else round(v, 9) for k, v in got.items()} == {k: v if v is None else round(v, 9) for k, v in want.items()}


def test_each_fact_is_scanned_once_and_its_rows_are_not_repeated(spark, star, periods, tmp_path, no_broadcast):
    path = str(tmp_path / "flow")
    star.facts["fact_passenger_flow"].write.parquet(path)
    facts = {**star.facts, "fact_passenger_flow": spark.read.parquet(path)}
    model = Model(facts, star.dimensions, star.relationships)
    text = plan(kpi.kpi_by_period(model, METRICS, periods))
    assert text.count(f"{path}]") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_targets_are_left_to_the_calendar(star):
    assert not daily.can_roll_up(star, ["Average Delay Target"], MEASURES)
    assert daily.can_roll_up(star, METRICS, MEASURES)


def test_empty_facts_and_no_periods(spark, star, periods):
    empty = Model({name: df.limit(0) for name, df in star.facts.items()}, star.dimensions, star.relationships)
    values = _values(kpi.kpi_by_period(empty, METRICS, periods))
    assert values["p1", "Revenue per Passenger"] == 0.0 and values["p1", "Total Transactions"] is None
    assert kpi.kpi_by_period(star, METRICS, periods.filter(F.lit(False))).count() == 0
