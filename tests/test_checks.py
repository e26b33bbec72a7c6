from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork.operators import checks as C
from tillwork.plans.check_suite import Check, run_checks, split_bad_rows, store_failures, violations


def make(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_null_and_value_rules(spark, rows):
    df = make(spark, "id int, city string", (1, "Barcelona"), (2, "London"), (2, "Paris"),
              (None, None), (None, "New York"))
    assert C.not_null(df, "id").count() == 2
    assert rows(C.unique(df, "id")) == [(2, 2)]
    assert C.unique(df, "city").count() == 0
    assert C.not_accepted_values(df, "city", ["Madrid", "Berlin"]).count() == 0
    assert rows(C.not_accepted_values(df, "city", ["Paris", "Oslo"])) == [("Paris",)]
    assert rows(C.accepted_values(df, "city", ["Barcelona", "London", "Paris"])) == [
        ("New York", 1)]


def test_accepted_range(spark):
    df = make(spark, "id int", (-1,), (11,), (None,))
    assert C.accepted_range(df, "id", -1, 11).count() == 0
    assert C.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert C.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert C.accepted_range(df.filter("id <> -1"), "id", 0).count() == 0
    assert C.accepted_range(df, "id", max_value=10).count() == 1
    assert C.accepted_range(df, "id").count() == 0
    pairs = df.sparkSession.createDataFrame([(1, 2), (3, 2), (2, 2), (None, 1)], "a int, b int")
    assert C.accepted_range(pairs, "a", max_value="b").count() == 1
    assert C.accepted_range(pairs, "a", max_value=F.col("b"), inclusive=False).count() == 2
    assert C.accepted_range(pairs, "a", min_value="b - 1").count() == 0


def test_at_least_one(spark, rows):
    df = make(spark, "field string, value int", ("a", 1), ("b", None))
    assert C.at_least_one(df, "field").count() == 0
    assert C.at_least_one(df, "value").count() == 0
    assert rows(C.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert C.at_least_one(df.limit(0), "value").count() == 1
    assert C.at_least_one(df.limit(0), "value", ["field"]).count() == 0


def test_cardinality_equality(spark, rows):
    a = make(spark, "same_name int", (1,), (2,), (3,))
    b = make(spark, "same_name int, different_name int", (1, 2), (2, 3), (3, 1))
    assert C.cardinality_equality(a, "same_name", b, "same_name").count() == 0
    assert C.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    more = make(spark, "x int", (1,), (1,), (2,), (None,))
    assert set(rows(C.cardinality_equality(a, "same_name", more, "x"))) == {
        (1, 1), (1, 2), (3, 1), (None, 1)}


def test_equal_rowcount(spark, rows):
    df = make(spark, "field int", (1,), (1,), (2,))
    assert C.equal_rowcount(df, df).count() == 0
    assert C.equal_rowcount(df, df, ["field"]).count() == 0
    assert rows(C.equal_rowcount(df, df.filter("field = 1"))) == [(3, 2, 1)]
    one_sided = df.filter("field = 1")
    assert rows(C.equal_rowcount(df, one_sided, ["field"])) == [(2, 1, 0, 1)]
    assert C.equal_rowcount(df, one_sided, ["field"], compat=True).count() == 0
    assert C.equal_rowcount(df, df.limit(0)).count() == 1
    assert C.equal_rowcount(df, df.limit(0), compat=True).count() == 0
    assert C.equal_rowcount(df.limit(0), df.limit(0)).count() == 0


def test_fewer_rows_than(spark, rows):
    small = make(spark, "col_a int, field int", (1, 1), (1, 2), (2, 3))
    large = make(spark, "col_a int, field int", (1, 1), (1, 2), (1, 3), (2, 4), (2, 5))
    assert C.fewer_rows_than(small, large).count() == 0
    assert C.fewer_rows_than(small, large, ["col_a"]).count() == 0
    assert rows(C.fewer_rows_than(large, small)) == [(5, 3, 2)]
    assert rows(C.fewer_rows_than(small, small)) == [(3, 3, 1)]
    assert C.fewer_rows_than(small, small.limit(0)).count() == 1
    assert C.fewer_rows_than(small, small.limit(0), compat=True).count() == 0


@pytest.fixture
def pair(spark):
    schema = "col_a int, col_b int, col_c int"
    return (make(spark, schema, (1, 1, 3), (1, 2, 1), (2, 3, 3)),
            make(spark, schema, (1, 1, 2), (1, 2, 2), (2, 3, 2)))


def test_equality(pair, rows):
    a, b = pair
    assert C.equality(a, a).count() == 0
    assert C.equality(a, a.union(a)).count() == 0
    assert rows(C.equality(a, a.union(a), multiset=True))[0] == ("b_minus_a", 1, 1, 3, 1)
    assert C.equality(a, b, compare_columns=["col_a", "col_b"]).count() == 0
    assert C.equality(a, b, exclude_columns=["COL_C"]).count() == 0
    assert {r[0] for r in rows(C.equality(a, b))} == {"a_minus_b", "b_minus_a"}
    assert C.equality(a, b).agg(C.equality_size().alias("n")).first()["n"] == 6
    assert C.equality(a, a.filter("col_b > 1")).agg(C.equality_size().alias("n")).first()["n"] == 2
    with pytest.raises(ValueError):
        C.equality(a, b, compare_columns=["col_a"], exclude_columns=["col_c"])
    with pytest.raises(ValueError):
        C.equality(a, b.drop("col_c"))


def test_equality_precision(spark):
    schema = "id string, float_number double, to_ignore string"
    a = make(spark, schema, *[(str(i), i * 1.2345, "a") for i in range(10)], (None, None, "a"))
    b = make(spark, schema, *[(str(i), i * 1.2345 + 1e-7, "b") for i in range(10)],
             (None, None, "b"))
    cells = ["id", "float_number"]
    assert C.equality(a, b, compare_columns=cells, precision=4).count() == 0
    assert C.equality(a, b, exclude_columns=["to_ignore"], precision=4).count() == 0
    assert C.equality(a, b, compare_columns=cells, precision=8).count() == 20
    assert C.equality(a, b, precision=4).count() == 22
    # zero digits is a precision like any other
    assert C.equality(a, b, compare_columns=cells, precision=0).count() == 0


def test_expression_is_true(spark):
    df = make(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5),
              (None, 1.0))
    assert C.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert C.expression_is_true(df.filter("col_a = 0.5"), "= 0.5", "col_b").count() == 0
    assert C.expression_is_true(df, "> 0", "col_a").count() == 1


def ranges(spark, *data):
    return make(spark, "g int, lo date, hi date",
                *[(g, date.fromisoformat(a), b and date.fromisoformat(b)) for g, a, b in data])


def test_mutually_exclusive_ranges(spark):
    joined = make(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    for gaps, bad in (("not_allowed", 0), ("allowed", 0), ("required", 2)):
        assert C.mutually_exclusive_ranges(joined, "lo", "hi", gaps=gaps).count() == bad
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(joined, "lo", "hi", gaps="some")
    gapped = ranges(spark, (1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"),
                    (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None))
    upper = "coalesce(hi, date '2099-01-01')"
    for gaps, bad in (("allowed", 0), ("required", 0), ("not_allowed", 2)):
        assert C.mutually_exclusive_ranges(gapped, "lo", upper, "g", gaps).count() == bad
    assert C.mutually_exclusive_ranges(gapped, "lo", "hi", "g").count() == 1


def test_zero_length_ranges(spark):
    df = ranges(spark, (3, "2020-05-06", "2020-05-08"), (3, "2020-05-08", "2020-05-08"),
                (3, "2020-05-08", "2020-05-10"), (4, "2020-06-06", "2020-06-08"),
                (4, "2020-06-08", "2020-06-08"), (4, "2020-06-08", "2020-06-10"),
                (4, "2020-06-10", "2020-06-11"))
    assert C.mutually_exclusive_ranges(
        df, "lo", "hi", "g", zero_length_range_allowed=True).count() == 0
    assert C.mutually_exclusive_ranges(df, "lo", "hi", "g").count() == 2


def test_repeated_ranges_come_back_as_often_as_they_occur(spark, rows):
    df = make(spark, "lo int, hi int", *[(0, 5)] * 4, (5, 6), (None, 7))
    bad = C.mutually_exclusive_ranges(df, "lo", "hi")
    assert rows(bad) == [(None, 7, 0, False), *[(0, 5, 0, False)] * 3]


def test_not_constant(spark, rows):
    df = make(spark, "col_a int, field int", (1, 1), (1, 1), (1, 2), (2, 5), (2, None), (3, None))
    assert C.not_constant(df, "field").count() == 0
    assert rows(C.not_constant(df, "field", ["col_a"])) == [(2, 1)]
    assert C.not_constant(df.limit(0), "field").count() == 0


def test_not_null_proportion(spark, rows):
    df = make(spark, "point_5 int, point_9 int",
              *[(1 if i < 5 else None, 1 if i < 9 else None) for i in range(10)])
    assert C.not_null_proportion(df, "point_5", 0.5, 0.5).count() == 0
    assert C.not_null_proportion(df, "point_9", 0.9).count() == 0
    assert rows(C.not_null_proportion(df, "point_5", 0.6)) == [(0.5,)]
    assert C.not_null_proportion(df.limit(0), "point_5", 0.6).count() == 0


def test_recency(spark):
    df = make(spark, "k string, at timestamp", ("a", datetime(2024, 1, 1, 1)),
              ("b", datetime(2023, 12, 31)))
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert C.recency(df, "at", "day", 1, now).count() == 0
    assert C.recency(df, "at", "day", 1, now, group_by=["k"]).count() == 1
    late = F.lit("2024-01-02 12:00:00").cast("timestamp")
    assert C.recency(df, "at", "day", 1, late).count() == 1
    assert C.recency(df, "at", "day", 1, late, ignore_time_component=True).count() == 0
    assert C.recency(df.limit(0), "at", "day", 1, now).count() == 0
    assert C.recency(df, "at", "day", 1).count() == 1


def test_relationships_where(spark, rows):
    child = make(spark, "id int", (1,), (2,), (4,), (4,), (None,))
    parent = make(spark, "id int", (1,), (2,), (3,), (None,))
    assert C.relationships_where(child, "id", parent, "id", "id <> 4").count() == 0
    assert rows(C.relationships_where(child, "id", parent, "id")) == [(4,), (4,)]
    assert C.relationships_where(child, "id", parent, "id", "id <> 4", "id <> 2").count() == 1


def test_sequential_values(spark, rows):
    df = make(spark, "col_a int, my_even_sequence int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert C.sequential_values(df, "my_even_sequence", 2).count() == 0
    assert C.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"]).count() == 0
    doubled = df.union(df)
    assert rows(C.sequential_values(doubled, "my_even_sequence", 2))[0] == (10, 10)
    assert C.sequential_values(doubled, "my_even_sequence", 2).count() == 5
    assert rows(C.sequential_values(df.filter("my_even_sequence <> 4"), "my_even_sequence", 2)) \
        == [(6, 2)]
    hours = make(spark, "at timestamp", *[(datetime(2021, 1, 1, h),) for h in range(4)])
    assert C.sequential_values(hours, "at", 1, "hour").count() == 0
    assert C.sequential_values(hours.filter(F.hour("at") != 2), "at", 1, "hour").count() == 1


def test_unique_combination_of_columns(spark, rows):
    df = make(spark, "month int, product string, revenue int", (1, "a", 5), (1, "b", 5),
              (2, "a", 5), (None, "a", 1), (None, "a", 2))
    assert C.unique_combination_of_columns(
        df.filter("month is not null"), ["month", "product"]).count() == 0
    assert rows(C.unique_combination_of_columns(df, ["month", "product"])) == [(None, "a")]


def test_not_empty_string(spark):
    df = make(spark, "s string", ("a  ",), ("   ",), ("",), (None,))
    assert C.not_empty_string(df, "s").count() == 2
    assert C.not_empty_string(df, "s", trim_whitespace=False).count() == 1


def test_assert_equal_and_columns(spark):
    df = make(spark, "actual int, expected int", (1, 1), (2, 3), (None, 3))
    assert C.assert_equal(df, "actual", "expected").count() == 1
    assert C.column_set_difference(df, ["ACTUAL", "other"]) == {
        "unexpected": ["expected"], "missing": ["other"]}


# ---- the suite

def test_suite_counts_like_single_checks_and_applies_thresholds(spark, pair, tmp_path):
    a, b = pair
    tables = {"a": a, "b": b, "people": make(spark, "id int, name string", (1, " "), (1, None))}
    report = {r["check_name"]: r for r in run_checks(tables, [
        Check("not_null", "people", "name"),
        Check("not_null", "people", "name", severity="warn", name="warned"),
        Check("not_null", "people", "name", error_if=">10", name="below"),
        Check("not_null", "people", "name", error_if=">10", warn_if=">5", name="far_below"),
        Check("not_null", "people", "name", where="id > 1", name="elsewhere"),
        Check("not_empty_string", "people", "name"),
        Check("unique", "people", "id"),
        Check("equality", "a", args={"other": "b"}),
        Check("equality", "a", args={"other": "a"}, error_if="<1", name="inverted"),
        Check("expression_is_true", "a", "col_a", {"expression": "> 1"}),
        Check("at_least_one", "people", "name", where="id > 1", name="none_there"),
        Check("not_constant", "people", "id"),
    ]).collect()}
    got = {name: (r["failures"], r["status"]) for name, r in report.items()}
    assert got == {
        "not_null_people_name": (1, "error"), "warned": (1, "warn"), "below": (1, "warn"),
        "far_below": (1, "pass"), "elsewhere": (0, "pass"),
        "not_empty_string_people_name": (1, "error"), "unique_people_id": (1, "error"),
        "equality_a": (6, "error"), "inverted": (0, "error"),
        "expression_is_true_a_col_a": (2, "error"), "none_there": (1, "error"),
        "not_constant_people_id": (1, "error"),
    }
    paths = store_failures(tables, [Check("unique", "people", "id")], str(tmp_path))
    assert spark.read.parquet(paths["unique_people_id"]).count() == 1


def test_suite_reads_a_table_once_for_all_row_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    make(spark, "id int, v int", (1, None), (2, 3)).write.parquet(path)
    df = spark.read.parquet(path)
    report = run_checks({"t": df}, [
        Check("not_null", "t", "id"), Check("not_null", "t", "v"),
        Check("accepted_range", "t", "v", {"min_value": 5}), Check("at_least_one", "t", "v"),
    ])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_suite_reads_a_table_once_for_all_value_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x"), (1, "b", None), (None, "b", "y"), (None, "b", "z"), (3, None, "y")],
                          "v int, w string, z string").write.parquet(path)
    wanted = [
        Check("unique", "t", "v"), Check("unique", "t", "z"),
        Check("accepted_values", "t", "w", {"values": ["a"]}),
        Check("not_accepted_values", "t", "w", {"values": ["a", "b", "c"]}),
        Check("unique_combination_of_columns", "t", args={"columns": ["w", "v"]}, name="wv"),
        Check("unique_combination_of_columns", "t", args={"columns": ["v", "w"]}, name="vw"),
        Check("unique", "t", "w", where="v is not null", name="alone"),
    ]
    tables = {"t": spark.read.parquet(path)}
    found = {r["check_name"]: r["failures"] for r in run_checks(tables, wanted).collect()}
    assert found == {c.label: violations(tables, c).count() for c in wanted} == {
        "unique_t_v": 1, "unique_t_z": 1, "accepted_values_t_w": 1, "not_accepted_values_t_w": 2, "wv": 1, "vw": 1,
        "alone": 0}
    plan = run_checks(tables, wanted[:-1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_suite_looks_for_a_single_value_with_a_limit(spark, tmp_path):
    path = str(tmp_path / "t")
    make(spark, "id int, v int", (1, None), (2, 3)).write.parquet(path)
    report = run_checks({"t": spark.read.parquet(path)}, [Check("at_least_one", "t", "v")])
    assert "Limit 1" in report._jdf.queryExecution().executedPlan().toString()
    assert report.first()["status"] == "pass"


def test_split_bad_rows(spark, rows):
    df = make(spark, "id int, v int", (1, 5), (2, None), (None, None))
    good, bad = split_bad_rows(df, {"no_v": C.null_rule("v"), "no_id": C.null_rule("id")})
    assert rows(good) == [(1, 5)]
    assert rows(bad) == [(None, None, ["no_v", "no_id"]), (2, None, ["no_v"])]


def test_equal_labels_are_refused(spark):
    table = spark.range(3)
    twice = [Check("expression_is_true", "t", args={"expression": e}) for e in ("id < 1", "id < 2")]
    with pytest.raises(ValueError, match="expression_is_true_t"):
        run_checks({"t": table}, twice)
    named = [twice[0], Check("expression_is_true", "t", args={"expression": "id < 2"},
                             severity="warn", name="below_two")]
    status = {r["check_name"]: r["status"] for r in run_checks({"t": table}, named).collect()}
    assert status == {"expression_is_true_t": "error", "below_two": "warn"}
