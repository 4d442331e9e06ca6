"""Filter context and dashboard queries over the airport model and the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries.airport_tables import model, with_tables
from driver_queries.q_measures import (
    AIRLINE_MEMBERS,
    DATE_COLUMN,
    DATE_JOIN,
    DATE_MEMBERS,
    FACT_SQL,
    STATUS_DIRECTION,
    _ratio0,
    grouped_sql,
    totals_sql,
)
from driver_queries.registry import f, n, query, t, table
from skyledger.plans import dashboard as D
from skyledger.plans.context import (
    Model,
    Relationship,
    filter_date_between,
    filter_in_list,
    filter_not_contains_any,
    filter_not_null,
    propagate_filters,
    star_join,
)
from skyledger.plans.measures import TARGET_CARDS, evaluate

START, END = date(1996, 3, 1), date(1997, 9, 16)
SLICER_SQL = "d >= DATE '1996-03-01' AND d < DATE '1997-09-16'"
SLICER_KEYS = """date_key IN (SELECT date_key FROM dim_date
    WHERE "date" >= DATE '1996-03-01' AND "date" < DATE '1997-09-16')"""
MEMBERS_IN_RANGE = f"{DATE_MEMBERS} WHERE {SLICER_KEYS}"


def slicer():
    return [filter_date_between("dim_date", "date", START, END)]


def _doubles(df, names):
    """Measure columns as doubles, as the SQL side rounds them."""
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


# ---------------------------------------------------------------- a small star of the driver tables


def trade(spark, sf) -> Model:
    """lineitem -> supplier -> nation and orders -> customer as two facts with a shared nation."""
    nation = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .select(F.col("n_nationkey").alias("nation_key"), "n_name", "r_name")
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation_key"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_quantity", "l_returnflag", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    return Model(
        facts={
            "sales": lines.join(suppliers, "s_suppkey", "left"),
            "orders": orders.join(customers, "o_custkey", "left"),
            "parts": parts,
        },
        dimensions={"nation": nation},
        relationships=(Relationship("sales", "nation_key", "nation"), Relationship("orders", "nation_key", "nation")),
    )


TRADE_SQL = """WITH nat AS (SELECT n_nationkey AS nation_key, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
    sales AS (SELECT l_suppkey, l_quantity, l_returnflag, l_shipdate, s_nationkey AS nation_key FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey),
    ord AS (SELECT o_orderkey, o_orderstatus, o_orderdate, c_nationkey AS nation_key FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
"""


@query(
    "star_join",
    TRADE_SQL
    + f"SELECT r_name, n_name, count(*) AS line_count, {f('sum(l_quantity)')} AS quantity FROM sales LEFT JOIN nat USING (nation_key) GROUP BY ALL",
)
def _(spark, sf):
    joined = star_join(trade(spark, sf), "sales", [("nation", "r_name"), ("nation", "n_name")], ["l_quantity"])
    return joined.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "filter_date_between",
    with_tables(
        f"""SELECT count(*) AS flights, {n('sum(passenger_count)')} AS passengers FROM fact_flight_operations
            WHERE {SLICER_KEYS}"""
    ),
)
def _(spark, sf):
    result = evaluate(model(spark, sf), ["Total Flights", "Total Passengers"], filters=slicer())
    return result.select(F.col("Total Flights").alias("flights"), F.col("Total Passengers").alias("passengers"))


@query(
    "filter_in_list",
    TRADE_SQL + "SELECT n_name, count(*) AS order_count FROM ord JOIN nat USING (nation_key) WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL",
)
def _(spark, sf):
    m = propagate_filters(trade(spark, sf), [filter_in_list("nation", "r_name", ["ASIA", "EUROPE"])])
    return star_join(m, "orders", [("nation", "n_name")], ["o_orderkey"]).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("order_count")
    )


@query(
    "filter_not_null",
    with_tables(
        """SELECT terminal_zone, CAST(sum(passengers_processed) AS BIGINT) AS passengers FROM fact_passenger_flow
           JOIN dim_terminal_zone USING (terminal_zone_key) WHERE terminal_zone IS NOT NULL GROUP BY ALL"""
    ),
)
def _(spark, sf):
    result = evaluate(
        model(spark, sf),
        ["Total Passengers Processed"],
        by=[D.ZONE],
        filters=[filter_not_null("dim_terminal_zone", "terminal_zone")],
    )
    return result.withColumnRenamed("Total Passengers Processed", "passengers")


@query(
    "filter_not_contains_any",
    """SELECT doc_id FROM documents WHERE NOT contains(lower(text), 'was') OR NOT contains(lower(text), 'the')""",
)
def _(spark, sf):
    rule = filter_not_contains_any("documents", "text", ["Was", "the"])
    return table(spark, sf, "documents").filter(rule.predicate).select("doc_id")


@query(
    "propagate_filters",
    TRADE_SQL
    + """SELECT 'sales' AS fact, count(*) AS row_count FROM sales JOIN nat USING (nation_key) WHERE r_name = 'ASIA'
       UNION ALL SELECT 'orders', count(*) FROM ord JOIN nat USING (nation_key) WHERE r_name = 'ASIA'
       UNION ALL SELECT 'parts', count(*) FROM part""",
)
def _(spark, sf):
    m = propagate_filters(trade(spark, sf), [filter_in_list("nation", "r_name", ["ASIA"])])
    parts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("fact"), "row_count")
        for name, rows in m.facts.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- shapes


def _cards_sql(measures, where):
    rows = []
    for measure in measures:
        target, variance, status = TARGET_CARDS[measure]
        rows.append(
            f"""SELECT '{measure}' AS measure, {f(f'"{measure}"', 4)} AS actual, {f(f'"{target}"', 4)} AS target,
                {f(f'"{variance}"', 4)} AS variance, "{status}" AS status FROM totals"""
        )
    return with_tables(" UNION ALL ".join(rows), totals=totals_sql(where))


@query("card_kpi_target", _cards_sql(list(STATUS_DIRECTION), SLICER_SQL), digits=4)
def _(spark, sf):
    return D.cards_kpi_target(model(spark, sf), list(STATUS_DIRECTION), slicer())


SINGLE = [
    item.measures[0] for item in D.VISUALS if item.shape == "card_single"
]


@query(
    "card_single",
    with_tables(
        "SELECT " + ", ".join(f"{f(chr(34) + name + chr(34), 4)} AS \"{name}\"" for name in SINGLE) + " FROM totals",
        totals=totals_sql(SLICER_SQL),
    ),
    digits=4,
)
def _(spark, sf):
    return _doubles(D.card_single(model(spark, sf), SINGLE, slicer()), SINGLE)


BAG_TREND = ["Total Bags Processed", "Mishandled Bags", "Mishandled Baggage Rate %"]


@query(
    "trend_by_date",
    grouped_sql(
        "fact_baggage_operations", BAG_TREND, DATE_COLUMN, DATE_JOIN, where=SLICER_KEYS, members=MEMBERS_IN_RANGE
    ),
    digits=4,
)
def _(spark, sf):
    return _doubles(D.trend_by_date(model(spark, sf), BAG_TREND, slicer()), BAG_TREND)


@query(
    "trend_by_date_cross_fact",
    with_tables(
        f"""SELECT {t('"date"')} AS "date", {f('electricity', 4)} AS "Total Electricity Consumption",
            {f(_ratio0('electricity', 'passengers'), 4)} AS "Energy per Passenger"
            FROM (SELECT date_key, sum(electricity_kwh) AS electricity FROM fact_sustainability_daily GROUP BY ALL)
            FULL OUTER JOIN (SELECT date_key, sum(passengers_processed) AS passengers FROM fact_passenger_flow GROUP BY ALL)
            USING (date_key) RIGHT JOIN dim_date USING (date_key) WHERE {SLICER_KEYS}"""
    ),
    digits=4,
)
def _(spark, sf):
    names = ["Total Electricity Consumption", "Energy per Passenger"]
    return D.trend_by_date(model(spark, sf), names, slicer())


@query(
    "trend_by_date_series",
    grouped_sql("fact_passenger_flow", ["Total Passengers Processed"], f"{DATE_COLUMN}, traffic_type", DATE_JOIN),
    digits=4,
)
def _(spark, sf):
    result = D.trend_by_date_series(model(spark, sf), "Total Passengers Processed", (D.FLOW, "traffic_type"))
    return _doubles(result, ["Total Passengers Processed"])


BY_AIRLINE = ["On-Time Performance %", "Average Delay Minutes", "Total Flights", "Cancellation Rate %"]


@query(
    "breakdown_by_attribute",
    grouped_sql(
        "fact_flight_operations",
        BY_AIRLINE,
        "airline_name",
        "LEFT JOIN dim_airline USING (airline_key)",
        where=SLICER_KEYS,
        members=AIRLINE_MEMBERS,
    ),
    digits=4,
)
def _(spark, sf):
    return _doubles(D.breakdown_by_attribute(model(spark, sf), D.AIRLINE, BY_AIRLINE, slicer()), BY_AIRLINE)


@query(
    "detail_table",
    with_tables(f"""SELECT {t('dim_date."date"')} AS "date", feedback_text FROM fact_passenger_feedback {DATE_JOIN}"""),
)
def _(spark, sf):
    return D.detail_table(model(spark, sf), D.FEEDBACK, ["feedback_text"], [D.DATE])


@query(
    "word_frequency",
    r"""SELECT word, count(*) AS frequency
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}'']+')) AS word FROM documents)
        WHERE word <> '' GROUP BY ALL""",
)
def _(spark, sf):
    return D.word_frequency(table(spark, sf, "documents"), "text")


@query(
    "slicer_domain",
    with_tables(
        """SELECT 'zone' AS slicer, terminal_zone AS value FROM dim_terminal_zone
           UNION ALL SELECT DISTINCT 'airline', airline_name FROM dim_airline
           UNION ALL SELECT DISTINCT 'traffic type', traffic_type FROM fact_passenger_flow
           UNION ALL SELECT DISTINCT 'category', revenue_category FROM fact_commercial_transactions"""
    ),
)
def _(spark, sf):
    m = model(spark, sf)
    slicers = {
        "zone": D.ZONE,
        "airline": D.AIRLINE,
        "traffic type": (D.FLOW, "traffic_type"),
        "category": (D.COMMERCIAL, "revenue_category"),
    }
    parts = [
        D.slicer_domain(m, attribute).select(F.lit(name).alias("slicer"), F.col(attribute[1]).alias("value"))
        for name, attribute in slicers.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "slicer_range",
    with_tables(f"""SELECT {t('min("date")')} AS min_value, {t('max("date")')} AS max_value FROM dim_date"""),
)
def _(spark, sf):
    return D.slicer_range(model(spark, sf))


# ---------------------------------------------------------------- every data visual of the pages

MEASURE_FACT = {name: fact for fact, measures in FACT_SQL.items() for name in measures}
JOINS = {
    "dim_airline": "LEFT JOIN dim_airline USING (airline_key)",
    "dim_terminal_zone": "LEFT JOIN dim_terminal_zone USING (terminal_zone_key)",
}


def _visual_sql(item: D.Visual) -> str | None:
    """SQL text of a visual under the date slicer."""
    names = list(item.measures)
    if item.shape == "card_kpi_target":
        return _cards_sql(names, SLICER_SQL)
    if item.shape == "card_single":
        columns = ", ".join(f"{f(chr(34) + name + chr(34), 4)} AS \"{name}\"" for name in names)
        return with_tables(f"SELECT {columns} FROM totals", totals=totals_sql(SLICER_SQL))
    if item.shape == "slicer_range":
        return with_tables(f"""SELECT {t('min("date")')} AS min_value, {t('max("date")')} AS max_value FROM dim_date""")
    if item.shape == "slicer_domain":
        left = f"WHERE {item.by[1]} IS NOT NULL" if item.by in (D.ZONE, D.AIRLINE) else ""
        return with_tables(f"SELECT DISTINCT {item.by[1]} FROM {item.by[0]} {left}")
    if item.shape == "detail_table":
        return with_tables(
            f"""SELECT {t('dim_date."date"')} AS "date", feedback_text FROM fact_passenger_feedback {DATE_JOIN}
                WHERE {SLICER_KEYS}"""
        )
    if item.shape == "word_frequency":
        return with_tables(
            r"""SELECT word, count(*) AS frequency FROM (SELECT unnest(regexp_split_to_array(lower(feedback_text),
                '[^\p{L}\p{N}'']+')) AS word FROM fact_passenger_feedback WHERE """
            + SLICER_KEYS
            + " AND (feedback_text NOT ILIKE '%was%' OR feedback_text NOT ILIKE '%the%')) WHERE word <> '' GROUP BY ALL"
        )
    key, joins, members = DATE_COLUMN, DATE_JOIN, MEMBERS_IN_RANGE
    if item.shape == "trend_by_date_series":
        key = f"{DATE_COLUMN}, {item.by[1]}"
    elif item.shape == "breakdown_by_attribute":
        key, joins = f'"{item.by[1]}"', JOINS.get(item.by[0], "")
        members = f"{item.by[1]} FROM {item.by[0]}" if item.by[0] in JOINS else ""
    facts = {MEASURE_FACT.get(name) for name in names}
    if len(facts) == 1 and None not in facts:
        return grouped_sql(facts.pop(), names, key, joins, where=SLICER_KEYS, members=members)
    # The two trends with energy per passenger beside a measure of another fact.
    first = names[0]
    fact = MEASURE_FACT[first]
    return with_tables(
        f"""SELECT {t('"date"')} AS "date", {f('a', 4)} AS "{first}",
            {f(_ratio0('electricity', 'passengers'), 4)} AS "Energy per Passenger"
            FROM (SELECT date_key, {FACT_SQL[fact][first]} AS a FROM {fact} GROUP BY ALL)
            FULL OUTER JOIN (SELECT date_key, sum(electricity_kwh) AS electricity FROM fact_sustainability_daily GROUP BY ALL)
            USING (date_key)
            FULL OUTER JOIN (SELECT date_key, sum(passengers_processed) AS passengers FROM fact_passenger_flow GROUP BY ALL)
            USING (date_key) RIGHT JOIN dim_date USING (date_key) WHERE {SLICER_KEYS}"""
    )


def _visual_key(item: D.Visual) -> str:
    words = f"visual_{item.page}_{item.name}".lower().replace("-", " ").split()
    return "_".join(words)


def _register(item: D.Visual) -> None:
    @query(_visual_key(item), _visual_sql(item), digits=4)
    def _(spark, sf):
        return _doubles(D.run_visual(model(spark, sf), item, slicer()), item.measures)


for _item in D.VISUALS:
    _register(_item)
