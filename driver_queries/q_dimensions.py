"""Dimension operators on the driver tables."""

from __future__ import annotations


from driver_queries.airport_tables import CleanTables, cleaned, landed, sql_key, with_tables
from driver_queries.registry import n, query, t, table
from skyledger.operators import dimensions as D
from skyledger.plans import airport

STACKED = """SELECT CAST(o_orderdate AS DATE) AS "date" FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
    UNION ALL SELECT CAST(ts AS DATE) FROM events"""
SPINE = f"""SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS "date"
    FROM (SELECT CAST(min("date") AS TIMESTAMP) AS lo, CAST(max("date") AS TIMESTAMP) AS hi FROM ({STACKED}))"""


def _stacked(spark, sf):
    return D.union_dates(
        [
            (table(spark, sf, "orders"), "o_orderdate"),
            (table(spark, sf, "lineitem"), "l_shipdate"),
            (table(spark, sf, "events"), "ts"),
        ]
    )


@query("union_dates", f"""SELECT {t('"date"')} AS "date" FROM ({STACKED})""")
def _(spark, sf):
    return _stacked(spark, sf)


@query("date_spine", f"""SELECT {t('"date"')} AS "date" FROM ({SPINE})""")
def _(spark, sf):
    return D.date_spine(_stacked(spark, sf))


@query(
    "calendar_attributes",
    f"""SELECT CAST(strftime("date", '%Y%m%d') AS BIGINT) AS date_key, {t('"date"')} AS "date", {n('day("date")')} AS "day",
        strftime("date", '%A') AS day_name, {n('weekofyear("date")')} AS week_of_year, {n('month("date")')} AS "month",
        strftime("date", '%B') AS month_name, {n('quarter("date")')} AS quarter, {n('year("date")')} AS "year",
        dayofweek("date") IN (0, 6) AS is_weekend FROM ({SPINE})""",
)
def _(spark, sf):
    return D.calendar_attributes(D.date_spine(_stacked(spark, sf)))


@query("surrogate_key", f"SELECT {sql_key('ds', 's_suppkey')} AS supplier_key, s_suppkey, s_name FROM supplier")
def _(spark, sf):
    return D.surrogate_key(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], "ds", "supplier_key")


@query(
    "surrogate_key_wide",
    f"SELECT {sql_key('do', 'o_orderdate, o_orderkey')} AS order_key, o_orderkey, {t('o_orderdate')} AS o_orderdate FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return D.surrogate_key(orders, ["o_orderdate", "o_orderkey"], "do", "order_key")


@query(
    "unknown_member",
    """SELECT 'ds0000' AS supplier_key, CAST(-1 AS BIGINT) AS s_suppkey, 'Unknown' AS s_name
       UNION ALL SELECT """
    + sql_key("ds", "s_suppkey")
    + ", s_suppkey, s_name FROM supplier",
)
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    keyed = D.surrogate_key(suppliers, ["s_suppkey"], "ds", "supplier_key")
    return D.unknown_member(keyed, ("ds0000", -1, "Unknown"))


@query(
    "distinct_dimension",
    "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL",
)
def _(spark, sf):
    return D.distinct_dimension(table(spark, sf, "customer"), "c_mktsegment")


@query(
    "project_dimension",
    f"SELECT {sql_key('dp', 'p_partkey')} AS part_key, p_partkey, p_name, p_brand, p_type FROM part",
)
def _(spark, sf):
    keyed = D.surrogate_key(table(spark, sf, "part"), ["p_partkey"], "dp", "part_key")
    return D.project_dimension(keyed, "part_key", "p_partkey", ["p_name", "p_brand", "p_type"])


@query(
    "build_dim_date",
    with_tables(
        f"""SELECT {n('date_key')} AS date_key, {t('"date"')} AS "date", {n('"day"')} AS "day", day_name,
            {n('week_of_year')} AS week_of_year, {n('"month"')} AS "month", month_name, {n('quarter')} AS quarter,
            {n('"year"')} AS "year", is_weekend FROM dim_date"""
    ),
)
def _(spark, sf):
    return airport.build_dim_date(CleanTables(spark, sf))


@query("build_dim_airline", with_tables("SELECT * FROM dim_airline"))
def _(spark, sf):
    return airport.build_dim_airline(landed(spark, sf, "airlines"))


@query("build_dim_gate", with_tables("SELECT * FROM dim_gate"))
def _(spark, sf):
    return airport.build_dim_gate(landed(spark, sf, "gates"))


@query("build_dim_flight", with_tables("SELECT * FROM dim_flight"))
def _(spark, sf):
    return airport.build_dim_flight(cleaned(spark, sf, "flights"))


@query("build_dim_terminal_zone", with_tables("SELECT * FROM dim_terminal_zone"))
def _(spark, sf):
    return airport.build_dim_terminal_zone(landed(spark, sf, "gates"))
