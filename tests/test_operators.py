import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tillwork.functions.keys import slugify
from tillwork.operators import checks, profile, reshape, spine
from tillwork.operators.dedup import deduplicate, first_by
from tillwork.operators.ordered import neighbour, positions, repeat_rows
from tillwork.sources.tables import read_seed


def test_deduplicate(spark, rows):
    df = spark.createDataFrame(
        [(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    best = deduplicate(df.filter("user_id = 1"), ["user_id"], [F.desc("version")])
    assert rows(best) == [(1, "play", 2)]
    again = deduplicate(best, ["user_id"], [F.desc("version")])
    assert rows(again) == rows(best)


def test_deduplicate_keeps_rows_with_nulls_and_drops_copies_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([(None, 1, None), (None, 2, "x")], "k int, v int, s string")
    best = deduplicate(df, ["k"], [F.asc("v")])
    assert rows(best) == [(None, 1, None)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_first_by(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 9, "c")], "k int, o int, v string")
    assert rows(first_by(df, ["k"], [F.col("o")], ["v"])) == [(1, "b"), (2, "c")]


def test_first_by_directions_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "c", 2), (1, None, 3), (2, None, 4), (2, "a", None), (2, "a", 6)], "k int, s string, place int")
    assert rows(first_by(df, ["k"], [F.desc_nulls_first("s")], ["place"])) == [(1, 3), (2, 4)]
    assert rows(first_by(df, ["k"], [F.desc_nulls_last("s"), F.asc_nulls_last("place")], ["place"])) == [(1, 2), (2, 6)]


OWN_NAMES = ["_id", "_range", "_place", "_rn", "_n", "_before", "_to", "_to_x", "_found", "_chunk", "_copy", "__id", "_a"]


@pytest.mark.parametrize("names", [("x", "g"), ("_id", "_range"), ("_to", "_to_x"), ("_n", "_before"), ("__id", "_place")])
def test_users_may_have_columns_called_like_our_own(spark, rows, names):
    value, group = names
    data = [(v, g) for g in (1, None) for v in (1, 2, 7, 9)]
    df = spark.createDataFrame(data, f"{value} int, {group} int")
    broken = checks.sequential_values(df, value, group_by=[group])
    assert rows(broken.select(group, value, f"previous_{slugify(value)}")) == [
        (None, 7, 2), (None, 9, 7), (1, 7, 2), (1, 9, 7)]
    placed = positions(df, [group], {"at": [value]})
    assert rows(placed.select(group, value, "at")) == [
        (g, v, i) for g in (None, 1) for i, v in enumerate((1, 2, 7, 9), 1)]
    linked = neighbour(df, [group], [value], "next", ahead=True, flag="last")
    assert rows(linked.select(group, value, "next", "last")) == [
        (g, v, n, n is None) for g in (None, 1) for v, n in ((1, 2), (2, 7), (7, 9), (9, None))]


def test_operators_keep_every_column(spark, rows):
    df = spark.createDataFrame([tuple(range(13)), tuple(range(1, 14))], ", ".join(f"{n} int" for n in OWN_NAMES))
    assert deduplicate(df, ["_id"], [F.col("_rn")]).columns == OWN_NAMES
    assert len(rows(repeat_rows(df.withColumn("times", F.lit(2)), "times"))) == 4
    assert repeat_rows(df.withColumn("times", F.lit(2)), "times").columns == OWN_NAMES
    assert checks.equality(df, df.limit(1)).columns == ["which_diff", *OWN_NAMES]
    assert rows(checks.equality(df, df.filter("_id = 0"))) == [("a_minus_b", *range(1, 14))]
    assert rows(checks.unique_combination_of_columns(df.unionByName(df), ["_n", "_a"])) == [(4, 12), (5, 13)]
    assert rows(checks.equal_rowcount(df, df.limit(0), ["_a"]).select("_a", "count_a")) == [(12, 1), (13, 1)]


# ---- ordered groups against plain windows

def _ordered(spark, n, keys, seed):
    rng = random.Random(seed)
    data = {(rng.choice(keys), rng.choice([None, *range(n)])) for _ in range(n)}
    return spark.createDataFrame(sorted(data, key=str), "g int, v int")


@pytest.mark.parametrize("keys", [[1], [1, 2, 3], [None, 1], list(range(50))])
@pytest.mark.parametrize("ahead", [False, True])
def test_neighbour_equals_window(spark, rows, keys, ahead):
    df = _ordered(spark, 400, keys, len(keys))
    w = Window.partitionBy("g").orderBy("v")
    move = F.lead if ahead else F.lag
    expected = df.select("*", move("v").over(w).alias("x"),
                         move(F.lit(1)).over(w).isNull().alias("none"))
    assert rows(neighbour(df, ["g"], ["v"], "x", ahead, "none")) == rows(expected)


def test_neighbour_without_groups(spark, rows):
    df = _ordered(spark, 300, [7], 3).select("v")
    expected = df.select("v", F.lag("v").over(Window.orderBy("v")).alias("x"))
    assert rows(neighbour(df, [], ["v"], "x")) == rows(expected)


@pytest.mark.parametrize("keys", [[1], [1, 1, 1, 2, None], list(range(60))])
def test_positions_equal_row_number(spark, rows, keys):
    df = _ordered(spark, 400, keys, 11).withColumn("less", -F.col("v"))
    expected = df.select("*", *[
        F.row_number().over(Window.partitionBy("g").orderBy(c)).cast("bigint").alias(n)
        for n, c in (("up", "v"), ("down", "less"))])
    assert rows(positions(df, ["g"], {"up": ["v"], "down": ["less"]})) == rows(expected)


def test_positions_without_groups(spark, rows):
    df = _ordered(spark, 300, [7], 3).select("v")
    expected = df.select("v", F.row_number().over(Window.orderBy("v")).cast("bigint").alias("n"))
    assert rows(positions(df, [], {"n": ["v"]})) == rows(expected)


def test_ordered_operators_on_no_rows(spark):
    df = _ordered(spark, 5, [1], 1).limit(0)
    assert neighbour(df, ["g"], ["v"], "x").count() == 0
    assert positions(df, ["g"], {"n": ["v"]}).count() == 0
    assert neighbour(df, [], ["v"], "x").count() == 0


def test_repeat_rows_over_chunk_borders(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10), ("d", 25)], "k string, n bigint")
    got = {r["k"]: r["count"] for r in repeat_rows(df, "n", chunk=10).groupBy("k").count().collect()}
    assert got == {"b": 1, "c": 10, "d": 25}


# ---- union

@pytest.fixture
def two(spark):
    return {
        "t1": spark.createDataFrame(
            [(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")],
            "id int, name string, favorite_number string"),
        "t2": spark.createDataFrame(
            [(1, "green", 7), (2, "pink", 13)],
            "id int, favorite_color string, favorite_number int"),
    }


def test_union_relations(two, rows):
    both = reshape.union_relations(two, source_column_name=None)
    assert both.columns == ["id", "name", "favorite_number", "favorite_color"]
    picked = both.select("id", "name", "favorite_color", "favorite_number")
    assert set(rows(picked)) == {
        (1, "drew", None, "pi"), (2, "bob", None, "e"), (3, "alice", None, "4"),
        (1, None, "green", "7"), (2, None, "pink", "13")}


@pytest.mark.parametrize("name", ["name", "NAME"])
def test_union_relations_exclude(two, name):
    both = reshape.union_relations(two, exclude=[name])
    assert both.columns == ["_source_relation", "id", "favorite_number", "favorite_color"]
    assert {r[0] for r in both.select("_source_relation").collect()} == {"t1", "t2"}


def test_union_relations_options(two, rows):
    ones = reshape.union_relations(two, where="id = 1", include=["ID", "favorite_number"],
                                   column_override={"id": "bigint"}, source_column_name="src")
    assert rows(ones) == [("t1", 1, "pi"), ("t2", 1, "7")]
    assert dict(ones.dtypes)["id"] == "bigint"
    with pytest.raises(ValueError):
        reshape.union_relations(two, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations(two, include=["nothing"])


def test_union_tables_like(spark, rows):
    for day, base in ((1, 1), (2, 3), (3, 5)):
        spark.createDataFrame(
            [(base, "play"), (base + 1, "pause")], "user_id int, event string"
        ).createOrReplaceTempView(f"data_events_2018010{day}")
    found = reshape.union_tables_with_prefix(spark, "data_events_", source_column_name=None)
    assert rows(found) == [(i, "play" if i % 2 else "pause") for i in range(1, 7)]
    part = reshape.union_tables_like(spark, "DATA_EVENTS_%", exclude="%02")
    assert part.count() == 4
    assert reshape.tables_like(spark, "data\\_events\\_%", "nowhere") == []
    with pytest.raises(ValueError):
        reshape.union_tables_like(spark, "none_such_%")


# ---- pivot and unpivot

@pytest.fixture
def shirts(spark):
    return spark.createDataFrame(
        [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")


def test_pivot(shirts, rows):
    wide = shirts.groupBy("size").agg(*reshape.pivot("color", ["red", "blue"]))
    assert wide.columns == ["size", "red", "blue"]
    assert rows(wide) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_slugs_and_apostrophes(shirts, rows):
    values = profile.column_values(shirts, "color", max_records=10)
    wide = shirts.groupBy("size").agg(*reshape.pivot("color", values, slug_names=True))
    assert sorted(wide.columns) == ["blue", "blues", "red", "size"]
    assert rows(wide.select("size", "red", "blue", "blues")) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_options(shirts, rows):
    cells = reshape.pivot("color", ["b%"], agg="max", cmp="like", prefix="p_", suffix="_s",
                          then_value="yes", else_value="no")
    assert rows(shirts.groupBy("size").agg(*cells)) == [("M", "no"), ("S", "yes")]
    sizes = shirts.selectExpr("size", "cast(length(color) as int) as n")
    small = reshape.pivot("n", [3, 10], cmp="<=", agg="count", else_value=None, prefix="to_")
    assert rows(sizes.agg(*small)) == [(2, 4)]
    bare = reshape.pivot("color", ["red"], alias=False)
    assert "red" in str(bare[0]) and shirts.agg(*bare).first()[0] == 2
    with pytest.raises(ValueError):
        reshape.pivot("color", ["red"], cmp="~")


def test_unpivot(spark, rows):
    df = spark.createDataFrame(
        [(123, date(2017, 1, 1), "active", "tier 1", "name 1"),
         (234, date(2017, 2, 1), "active", "tier 3", "name 3"),
         (567, date(2017, 3, 1), "churned", "tier 2", "name 2")],
        "customer_id int, created_at date, sTaTuS string, segment string, name string")
    tall = reshape.unpivot(df, exclude=["CUSTOMER_ID", "created_at"], remove=["Name"],
                           field_name="prop", value_name="val")
    assert tall.columns == ["customer_id", "created_at", "prop", "val"]
    assert rows(tall)[:2] == [(123, date(2017, 1, 1), "sTaTuS", "active"),
                              (123, date(2017, 1, 1), "segment", "tier 1")]
    assert tall.count() == 6


def test_unpivot_booleans_keep_nulls(spark, rows):
    df = spark.createDataFrame([(1, True, 5), (2, False, 6), (3, None, None)],
                               "id int, flag boolean, n int")
    tall = reshape.unpivot(df, exclude=["id"])
    assert set(rows(tall)) == {(1, "flag", "true"), (2, "flag", "false"), (3, "flag", None),
                               (1, "n", "5"), (2, "n", "6"), (3, "n", None)}


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 99), st.integers(), st.integers()).map(
    lambda t: (t[0], t[1] % 2**31 - 2**30, t[2] % 2**31 - 2**30)), min_size=1, max_size=20))
def test_unpivot_has_a_row_per_row_and_column(spark, data):
    df = spark.createDataFrame(data, "id int, a int, b int")
    assert reshape.unpivot(df, "int", exclude=["id"]).count() == 2 * len(data)


# ---- columns

@pytest.fixture
def fields(spark):
    return spark.createDataFrame(
        [("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")],
        "field_1 string, field_2 string, field_3 string")


def test_star(fields):
    assert fields.select(*reshape.star(fields, ["FIELD_3"])).columns == ["field_1", "field_2"]
    affixed = reshape.star(fields, ["field_3"], "prefix_", "_suffix", alias="f")
    assert fields.alias("f").select(*affixed).columns == [
        "prefix_field_1_suffix", "prefix_field_2_suffix"]
    assert reshape.star(fields, ["field_1", "field_2", "field_3"]) == []


def test_star_in_group_by(spark, rows):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)],
                               "group_field_1 string, group_field_2 string, value_field int")
    summed = df.groupBy(*reshape.star(df, ["value_field"])).agg(F.sum("value_field"))
    assert rows(summed) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    assert rows(reshape.group_by_first(df, 2).agg(F.sum("value_field"))) == rows(summed)
    with pytest.raises(ValueError):
        reshape.group_by_first(df, 4)


def test_filtered_columns(fields, rows):
    kept = reshape.filtered_columns(fields, ["field_1"])
    assert rows(fields.agg(*[F.max(c) for c in kept])) == [("h", "i")]


def test_empty_to_null(spark, rows):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)],
                               "field_1 string, field_2 string, field_3 int")
    assert rows(reshape.empty_to_null(df)) == [(None, None, 3), (None, "b", 2), ("a", None, 1)]
    assert rows(reshape.empty_to_null(df, ["field_2"]))[0] == ("", None, 3)


# ---- series and profiles

def test_generate_series(spark, rows):
    assert rows(spine.generate_series(spark, 10)) == sorted(((i,) for i in range(1, 11)), key=str)
    with pytest.raises(ValueError):
        spine.generate_series(spark, 0)


def test_date_spine(spark):
    days = [r[0].date() for r in spine.date_spine(
        spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert days == [date(2018, 1, d) for d in range(1, 10)]
    with pytest.raises(ValueError):
        spine.date_spine(spark, "day", "2018-01-10", "2018-01-10")
    months = spine.date_spine(spark, "month", "2018-01-31", "2018-05-01")
    assert [r[0].date() for r in months.orderBy("date_month").collect()] == [
        date(2018, 1, 31), date(2018, 2, 28), date(2018, 3, 31), date(2018, 4, 30)]


def test_fill_weeks(spark, rows):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "a", 5), (date(2024, 1, 15), None, 7)], "w date, k string, n int")
    filled = spine.fill_weeks(df, "w", ["k"], ["n"])
    assert set(rows(filled)) == {
        (date(2024, 1, 1), "a", 5), (date(2024, 1, 8), "a", 0), (date(2024, 1, 15), "a", 0),
        (date(2024, 1, 1), None, 0), (date(2024, 1, 8), None, 0), (date(2024, 1, 15), None, 7)}
    assert spine.fill_weeks(df.limit(0), "w", ["k"], ["n"]).count() == 0


def test_column_values(spark):
    data = [(c,) for c in "abcdef"] + [("g",)] * 5
    df = spark.createDataFrame(data, "field string")
    assert profile.column_values(df, "field", max_records=100) == ["g", "a", "b", "c", "d", "e", "f"]
    assert profile.column_values(df, "field", max_records=2) == ["g", "a"]
    assert profile.column_values(df, "field", 9, where="field > 'x'", default=["none"]) == ["none"]
    assert profile.column_values("missing_table", "field", 9, spark, default=[]) == []
    with pytest.raises(LookupError):
        profile.column_values("missing_table", "field", 9, spark)
    counts = {r["value"]: r["n"] for r in profile.value_counts(df, "field").collect()}
    assert counts == {**dict.fromkeys("abcdef", 1), "g": 5}


def test_single_value_and_dict(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)],
                               "col_1 int, col_2 string, col_3 boolean")
    assert profile.single_value(df.orderBy("col_1")) == 1
    assert profile.single_value(df.filter("col_1 > 9"), default="none") == "none"
    assert profile.as_dict(df.orderBy("col_1"), 3) == {
        "col_1": [1, 2, 3], "col_2": ["a", "b", "c"], "col_3": [True, False, None]}
    assert profile.column_values(df, "col_1", max_records=2) == [1, 2]
    with pytest.raises(ValueError):
        profile.as_dict(df, 2)


def test_seed_reads_declared_types_and_empty_as_null(spark, rows, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('id,name,day\n1,,2020-01-01\n2,"",\n3,x,2020-01-03\n')
    seed = read_seed(spark, str(path), "id int, name string, day date")
    assert rows(seed) == [(1, None, date(2020, 1, 1)), (2, None, None), (3, "x", date(2020, 1, 3))]
