"""Properties of the operators, against brute force on small tables."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.operators import clean, dimensions, facts, joins, ordering, quality
from skyledger.plans.kpi import top_with_ties
from skyledger.plans.measures import drill_across
from skyledger.plans.targets import COVER, target_asof


def collect(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


def test_row_numbers_equal_the_global_window(spark, many_ranges):
    rows = spark.range(5000).select(
        F.col("id"), (F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3 == 0).alias("hot")
    )
    # A third of the rows ties on the leading order column.
    rows = rows.select("id", F.when(F.col("hot"), F.lit(42)).otherwise(F.col("a")).alias("a"))
    ranged = ordering.order_ranges(rows, [F.col("a"), F.col("id")])
    sizes = [row["count"] for row in ranged.groupBy(ordering.RANGE).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500
    numbered = ordering.global_row_number(rows, [F.col("a"), F.col("id")], "n")
    expected = rows.withColumn("n", F.row_number().over(Window.orderBy("a", "id")))
    assert collect(numbered, "id") == collect(expected, "id")


def test_row_numbers_are_gapless_with_ties(spark, many_ranges):
    rows = spark.range(3000).select("id", F.lit(1).alias("same"))
    numbered = ordering.global_row_number(rows, [F.col("same")], "n")
    assert sorted(row["n"] for row in numbered.collect()) == list(range(1, 3001))
    sizes = ordering.order_ranges(rows, [F.col("same")]).groupBy(ordering.RANGE).count()
    assert sizes.count() > 4


def test_surrogate_key_keeps_all_digits(spark):
    keyed = dimensions.surrogate_key(spark.range(10001), ["id"], "df", "k")
    keys = {row["id"]: row["k"] for row in keyed.collect()}
    assert keys[0] == "df0001" and keys[9998] == "df9999" and keys[9999] == "df10000"
    assert len(set(keys.values())) == 10001


def _impute_by_hand(values):
    result = []
    for i, value in enumerate(values):
        if value is None:
            before = next((v for v in reversed(values[:i]) if v is not None), None)
            after = next((v for v in values[i + 1 :] if v is not None), None)
            value = None if before is None or after is None else (before + after) / 2
        result.append(value)
    return result


@pytest.mark.parametrize("gap", [0.3, 0.97])
def test_impute_matches_brute_force(spark, many_ranges, gap):
    rng = random.Random(7)
    series = {"a": 1500, "b": 40, "c": 1, "d": 700, None: 60}
    rows, expected = [], {}
    for name, size in series.items():
        values = [None if rng.random() < gap else float(rng.randint(0, 1000)) for _ in range(size)]
        rows += [(name, i, value) for i, value in enumerate(values)]
        expected.update({(name, i): value for i, value in enumerate(_impute_by_hand(values))})
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, t int, v double")
    filled = clean.impute_neighbour_mean(df, ["t"], "v", series=["s"])
    assert {(row["s"], row["t"]): row["v"] for row in filled.collect()} == expected
    # One long series: the whole table in one order.
    single = df.filter("s = 'a'").drop("s")
    filled = clean.impute_neighbour_mean(single, ["t"], "v")
    assert {("a", row["t"]): row["v"] for row in filled.collect()} == {k: v for k, v in expected.items() if k[0] == "a"}


def test_impute_keeps_end_nulls_and_runs_of_nulls(spark):
    values = [None, 2.0, None, None, 8.0, None]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v double")
    filled = clean.impute_neighbour_mean(df, ["t"], "v")
    assert [row["v"] for row in filled.orderBy("t").collect()] == [None, 2.0, 5.0, 5.0, 8.0, None]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(5))
        .when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.col("id") % 400)
        .alias("k"),
    )
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(5, -1), (None, -2)], "k bigint, v bigint")
    )
    if how in ("left_semi", "left_anti"):
        right = right.select("k")
    plain = left.join(right, "k", how)
    salted = joins.salted_join(left, right, ["k"], how, salts=8)
    assert salted.columns == plain.columns
    assert collect(salted, *salted.columns) == collect(plain, *plain.columns)


def test_hot_keys_finds_the_hot_third(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    expected = spark.range(1).select(F.xxhash64(F.lit(-1).cast("bigint")).alias("h")).first()["h"]
    assert [row["__hash"] for row in joins.hot_keys(df, ["k"]).collect()] == [expected]


def test_salted_join_spreads_the_hot_key(spark, no_broadcast):
    left = spark.range(4000).select("id", F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right, ["k"])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 2000


def test_lookup_keeps_every_fact_row(spark, no_broadcast):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, code string")
    dim = spark.createDataFrame([("a", "k1"), ("b", "k2")], "code string, key string")
    keyed = facts.lookup_keys(fact, [facts.Lookup(dim, "code", "key")])
    assert {row["id"]: row["key"] for row in keyed.collect()} == {1: "k1", 2: "k2", 3: None, 4: None}
    mapped = facts.map_unknown_key(keyed, "key", "k0")
    assert {row["id"]: row["key"] for row in mapped.collect()} == {1: "k1", 2: "k2", 3: "k0", 4: "k0"}


def test_grain_keeps_totals_and_weights(spark):
    rows = [("d", 61, 13.0), ("d", 79, 10.0), ("e", 0, 13.0), ("f", None, 8.0), ("g", 4, None), ("g", 4, 6.0)]
    df = spark.createDataFrame(rows, "g string, n int, w double")
    grain = facts.aggregate_to_grain(df, ["g"], ["n"], {"w": (F.col("w"), F.col("n"))})
    result = {row["g"]: (row["n"], row["w"]) for row in grain.collect()}
    assert result == {"d": (140, 1583 / 140), "e": (0, None), "f": (None, None), "g": (8, 3.0)}


def test_drill_across_totals(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 10), ("y", 20), (None, 30)], "k string, b int")
    both = {row["k"]: (row["a"], row["b"]) for row in drill_across([a, b], ["k"]).collect()}
    assert both == {"x": (1, 10), "y": (None, 20), None: (2, 30)}


def test_orphans_with_and_without_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    ref = spark.createDataFrame([("a",), (None,)], "k string")
    assert {row["id"] for row in quality.orphan_rows(df, ref, "k").collect()} == {2, 3}
    assert {row["id"] for row in quality.orphan_rows_nonnull(df, ref, "k").collect()} == {2}


def test_rule_violations_pass_nulls(spark):
    df = spark.createDataFrame([(1, 5, 6), (2, 7, 6), (3, None, 6)], "id int, used int, seats int")
    broken = quality.rule_violations(df, F.col("used") <= F.col("seats"))
    assert [row["id"] for row in broken.collect()] == [2]


def test_ranking_keeps_all_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 9.0), ("c", 9.0), ("d", None), ("e", 1.0)], "m string, value double")
    assert {row["m"] for row in top_with_ties(df, "value").collect()} == {"b", "c"}
    assert {row["m"] for row in top_with_ties(df, "value", 1, ascending=True).collect()} == {"e"}
    assert {row["m"] for row in top_with_ties(df, "value", 3).collect()} == {"a", "b", "c"}


def test_fk_null_counts_on_an_empty_fact(spark):
    empty = spark.createDataFrame([], "k string")
    assert quality.fk_null_counts(empty, ["k"]).first()["k_nulls"] is None


def test_large_value_mapping_equals_small_one(spark, no_broadcast):
    df = spark.createDataFrame([(1, "DOM"), (2, "x"), (3, None)], "id int, t string")
    table = spark.createDataFrame([("DOM", "Domestic")], "variant string, canonical string")
    by_case = clean.standardize_values(df, "t", {"DOM": "Domestic"})
    by_join = clean.standardize_values(df, "t", table)
    assert collect(by_case, "id") == collect(by_join, "id") == [(1, "Domestic"), (2, "x"), (3, None)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("kinds", [("int", "bigint"), ("bigint", "int"), ("date", "timestamp"), ("decimal(12,2)", "bigint"), ("float", "double")])
def test_salted_join_with_keys_of_two_types(spark, no_broadcast, kinds, how):
    keys = [7] * 1000 + [k % 900 for k in range(2000)] + [None] * 5
    base = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k int, n int")
    other = spark.createDataFrame([(k, -k) for k in range(0, 900, 2)] + [(7, -7)], "k int, m int")

    def typed(df, kind):
        if kind in ("date", "timestamp"):
            return df.withColumn("k", F.expr("date_add(date '2020-01-01', k)").cast(kind))
        return df.withColumn("k", F.col("k").cast(kind))

    left, right = typed(base, kinds[0]), typed(other, kinds[1])
    plain, salted = left.join(right, "k", how), joins.keyed_join(left, right, ["k"], how)
    assert plain.columns == salted.columns
    assert sorted(map(repr, plain.select("n").collect())) == sorted(map(repr, salted.select("n").collect()))


def test_keys_without_a_common_type_raise(spark, no_broadcast):
    left, right = spark.createDataFrame([("1",)], "k string"), spark.createDataFrame([(1,)], "k int")
    with pytest.raises(TypeError):
        joins.keyed_join(left, right, ["k"])


def test_row_hash_leaves_out_nested_maps(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('m', map(1, 2)) AS s, array(map(1, 2)) AS l")
    assert df.select(joins.row_hash(df)).collect() == df.select(joins.row_hash(df.select("a"))).collect()
    only = df.select("s")
    assert only.select(joins.row_hash(only)).collect()[0][0] == 0


def test_whole_numbers_keep_their_digits(spark):
    from skyledger.functions.numeric import whole_number

    texts = ["3000000000", "9007199254740993", "167.0", "-2.9", "x", "", "99999999999999999999", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(whole_number(F.col("t")))
    assert [r[0] for r in rows.collect()] == [3000000000, 9007199254740993, 167, -2, None, None, None, None]


def test_targets_are_covered_by_few_blocks_and_match_every_day(spark):
    start = date(1999, 12, 25)
    spans = [(0, 0), (0, 63), (1, 62), (5, 5), (7, 40), (30, None), (63, 63), (-20, 200), (9, 3)]
    rows = [
        (f"K{i % 3}", float(i), start + timedelta(b), None if e is None else start + timedelta(e))
        for i, (b, e) in enumerate(spans)
    ]
    frame = spark.createDataFrame(
        rows, "kpi_code string, target_value double, effective_start_date date, effective_end_date date"
    )
    days = [start + timedelta(k) for k in range(64)]
    found = target_asof(spark.createDataFrame([(d,) for d in days], "d date"), "d", frame)
    expected = {}
    for day in days:
        for code, value, begin, end in rows:
            if begin <= day and (end is None or day <= end):
                expected[day, code] = max(value, expected.get((day, code), value))
    assert {(r["d"], r["kpi_code"]): r["target_value"] for r in found.collect()} == expected
    covers = spark.range(1).select(F.lit(730_001).alias("__begin"), F.lit(731_999).alias("__end")).select(F.expr(COVER).alias("c"))
    cover = covers.first()["c"]
    covered = sorted(x for b in cover for x in range(b["block"] << b["level"], (b["block"] + 1) << b["level"]))
    assert covered == list(range(730_001, 732_000)) and len(cover) <= 22
