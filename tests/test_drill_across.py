"""Measures of facts that are related to some of the attributes only."""

import pytest
from pyspark.sql import functions as F

from skyledger.plans.context import Model, Relationship, filter_in_list
from skyledger.plans.measures import Aggregate, Derived, evaluate


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def stars(spark):
    days = spark.createDataFrame([(d, f"day {d}") for d in (1, 2, 3)] + [(4, None)], "day_key int, day string")
    lines = spark.createDataFrame([(a, f"line {a}") for a in (1, 2)], "line_key int, line string")
    trips = [(1, 1, 10), (1, 1, 5), (1, 2, 7), (2, 1, 1), (4, 2, 3), (None, 1, 2), (9, None, 4)]
    sales = [(1, 100.0), (1, 50.0), (3, 7.0), (4, 11.0), (None, 13.0)]
    return Model(
        facts={
            "trips": spark.createDataFrame(trips, "day_key int, line_key int, seats int"),
            "sales": spark.createDataFrame(sales, "day_key int, amount double"),
            "fees": spark.createDataFrame([(1000.0,), (1.0,)], "fee double"),
        },
        dimensions={"days": days, "lines": lines},
        relationships=(
            Relationship("trips", "day_key", "days"),
            Relationship("trips", "line_key", "lines"),
            Relationship("sales", "day_key", "days"),
        ),
        date_dimension="days",
    )


MEASURES = {
    "seats": Aggregate("trips", ("seats",), lambda: F.sum("seats")),
    "amount": Aggregate("sales", ("amount",), lambda: F.sum("amount")),
    "fees": Aggregate("fees", ("fee",), lambda: F.sum("fee")),
    "amount per seat": Derived(("amount", "seats"), lambda a, b: a / b),
}
BY = [("days", "day"), ("lines", "line")]


def test_values_repeat_beside_each_group_and_blank_groups_meet(stars):
    got = {(r["day"], r["line"]): tuple(r)[2:] for r in evaluate(stars, ["seats", "amount", "fees", "amount per seat"], BY, registry=MEASURES).collect()}
    # Sales of the unknown day, of the day without a name and of unmatched trips are one blank day.
    assert got == {
        ("day 1", "line 1"): (15, 150.0, 1001.0, 10.0),
        ("day 1", "line 2"): (7, 150.0, 1001.0, 150.0 / 7),
        ("day 2", "line 1"): (1, None, 1001.0, None),
        (None, "line 2"): (3, 24.0, 1001.0, 8.0),
        (None, "line 1"): (2, 24.0, 1001.0, 12.0),
        (None, None): (4, 24.0, 1001.0, 6.0),
    }


def test_filters_reach_the_partly_related_fact(stars):
    rows = evaluate(stars, ["seats", "amount"], BY, [filter_in_list("days", "day", ["day 1"])], registry=MEASURES).collect()
    assert sorted(tuple(r) for r in rows) == [("day 1", "line 1", 15, 150.0), ("day 1", "line 2", 7, 150.0)]
    rows = evaluate(stars, ["seats", "amount"], BY, [filter_in_list("lines", "line", ["line 2"])], registry=MEASURES).collect()
    assert sorted(tuple(r) for r in rows if r["day"]) == [("day 1", "line 2", 7, 150.0)]


def test_there_is_no_product_in_the_plan(stars, no_broadcast):
    text = plan(evaluate(stars, ["seats", "amount", "amount per seat"], BY, registry=MEASURES))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_groups_need_a_measure_of_all_attributes(stars):
    with pytest.raises(ValueError, match="no measure"):
        evaluate(stars, ["amount"], BY, registry=MEASURES)
