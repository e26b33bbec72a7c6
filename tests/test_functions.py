from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillwork.functions import arithmetic as A, calendar, geo, web
from tillwork.functions.keys import slugify, surrogate_key


def one(spark, cell):
    return spark.range(1).select(cell.alias("x")).first()["x"]


def test_calendar_agrees_with_strftime_on_every_day(spark):
    first, count = date(2015, 1, 1), 5844
    days = spark.range(count).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    cells = calendar.week_columns(F.col("d"))
    iso = calendar.week_columns(F.col("d"), "iso")
    got = days.select(
        "d", cells["order_week"].alias("u"), cells["year_week"].alias("w"),
        calendar.week_start(F.col("d")).alias("m"), iso["year_week"].alias("iso"),
        iso["order_year"].alias("iy"), iso["order_week"].alias("iw"),
    ).collect()
    assert len(got) == count
    for r in got:
        d = r["d"]
        assert r["u"] == int(d.strftime("%U")) and r["w"] == d.strftime("%Y-W%W")
        assert r["m"] == d - timedelta(days=d.weekday())
        assert r["iso"] == d.strftime("%G-W%V")
        assert (r["iy"], r["iw"]) == d.isocalendar()[:2]


@pytest.mark.parametrize("day, label, week", [
    ("2025-12-28", "2025-W51", 52), ("2025-12-29", "2025-W52", 52), ("2026-01-01", "2026-W00", 0),
    ("2026-01-04", "2026-W00", 1), ("2026-01-05", "2026-W01", 1), ("2026-01-11", "2026-W01", 2),
])
def test_calendar_spot_values(spark, day, label, week):
    cells = calendar.week_columns(F.lit(day).cast("date"))
    assert one(spark, cells["year_week"]) == label
    assert one(spark, cells["order_week"]) == week


def test_calendar_rejects_unknown_names():
    with pytest.raises(ValueError):
        calendar.week_columns(F.lit(1), "lunar")
    with pytest.raises(ValueError):
        calendar.check_datepart("fortnight")


@pytest.mark.parametrize("part, start, end, n", [
    ("month", "2020-01-31", "2020-02-01", 1), ("day", "2018-01-01", "2018-01-10", 9),
    ("year", "2019-12-31", "2020-01-01", 1), ("hour", "2020-01-01 00:59:00", "2020-01-01 02:01:00", 2),
    ("week", "2020-01-04", "2020-01-05", 1), ("week", "2020-01-05", "2020-01-11", 0),
    ("isoweek", "2020-01-05", "2020-01-06", 1), ("isoweek", "2020-01-06", "2020-01-12", 0), ("day", "2020-01-02", "2020-01-01", -1),
])
def test_intervals_count_boundaries(spark, part, start, end, n):
    assert calendar.count_intervals(spark, part, start, end) == n


def test_surrogate_key_values(spark):
    data = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    df = spark.createDataFrame(data, "a string, b string, c string")
    got = df.select(
        surrogate_key(F.col("a"), F.col("b"), F.col("c")).alias("all"),
        surrogate_key(F.col("a")).alias("first")).collect()
    assert [r["all"] for r in got] == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"]
    assert [r["first"] for r in got] == [
        *["0cc175b9c0f1b6a831c399e269772661"] * 2, *["f14cc5cdce0420f4a5a6b6d9d7b85f39"] * 2]
    blank = df.select(surrogate_key(F.col("b"), nulls_as_empty=True).alias("k")).collect()
    assert blank[1]["k"] == "d41d8cd98f00b204e9800998ecf8427e"


@pytest.mark.parametrize("text, slug", [
    ("", ""), (None, ""), ("!Hell0 world-hi", "hell0_world_hi"),
    ("0Hell0 world-hi", "_0hell0_world_hi"), ("blue's", "blues"),
])
def test_slugify(text, slug):
    assert slugify(text) == slug


def test_safe_add_and_subtract(spark):
    def ints(*values):
        return [F.lit(v).cast("int") for v in values]

    for values, total in [((1, 2, 3), 6), ((1, None, 3), 4), ((None, None, 2), 2),
                          ((None, None, None), 0)]:
        assert one(spark, A.safe_add(*ints(*values))) == total
    for values, rest in [((3, 2, 1), 0), ((4, None, 3), 1), ((None, None, 2), -2),
                         ((None, None, None), 0)]:
        assert one(spark, A.safe_subtract(*ints(*values))) == rest


@pytest.mark.parametrize("top, bottom, expected", [
    (6, 0, None), (10, 5, 2), (None, None, None), (None, 0, None), (17, None, None),
    (0, None, None), (None, 9, None), (0, 5, 0),
])
def test_safe_divide(spark, top, bottom, expected):
    got = one(spark, A.safe_divide(F.lit(top).cast("int"), F.lit(bottom).cast("int")))
    assert got == expected


def test_safe_divide_of_expressions(spark):
    def product(a, b):
        return F.lit(a) * F.lit(b)

    for a, b, bottom, expected in [(0, 5, 9, 0), (2, 3, 0, None), (2, 5, 2, 5)]:
        assert one(spark, A.safe_divide(product(a, b), F.lit(bottom))) == expected
    for top, a, b, expected in [(6, 3, 2, 1), (0, 2, 6, 0), (4, 0, 4, None)]:
        assert one(spark, A.safe_divide(F.lit(top), product(a, b))) == expected


BINS = [(190000, 0), (290000, 1), (320000, 2), (399999.99, 2), (400000, 3), (470000, 3),
        (510000, 4), (610000, 5)]


@pytest.mark.parametrize("amount, bucket", BINS)
def test_width_bucket(spark, amount, bucket):
    assert one(spark, A.width_bucket(F.lit(amount), 200000, 600000, 4)) == bucket
    assert one(spark, A.width_bucket_modulo(F.lit(amount), 200000, 600000, 4)) == bucket


def test_width_bucket_rules_part_off_the_grid(spark):
    for value, plain, modulo in [(25, 3, 2), (-20, 0, -1), (45, 5, 4)]:
        assert one(spark, A.width_bucket(F.lit(value), 5, 45, 4)) == plain
        assert one(spark, A.width_bucket_modulo(F.lit(value), 5, 45, 4)) == modulo


def test_round_half_up_on_exact_amounts(spark):
    half = F.lit("1.005").cast("decimal(18,4)")
    assert one(spark, A.round_money(half)) == 1.01
    assert one(spark, A.round_ratio(F.lit(237778.855))) == 237778.86


def test_haversine(spark):
    spots = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, geo.haversine(*spots))) == 267
    assert round(one(spark, geo.haversine(*spots, unit="km"))) == 430
    with pytest.raises(ValueError):
        geo.haversine(*spots, unit="m")


@pytest.mark.parametrize("url, host", [
    ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk"),
    ("android-app://m.facebook.com/", "m.facebook.com"),
    ("docs.nytimes.com/2021/01/01/index.js?a=b", "docs.nytimes.com"),
    ("https://www.example.com/a/b", "www.example.com"), ("http://h?x=/y", "h"),
])
def test_url_host(spark, url, host):
    assert one(spark, web.url_host(F.lit(url))) == host


@pytest.mark.parametrize("url, path", [
    ("www.google.co.uk?utm_source=google", ""),
    ("https://www.nytimes.com/2018/01/01/blog", "2018/01/01/blog"),
    ("http://www.nytimes.com/2018/01/01/blog/?x=1", "2018/01/01/blog/"),
    ("example.com", "example.com"), ("android-app://h/", "/h/"), ("h/a#top", "a#top"),
])
def test_url_path(spark, url, path):
    assert one(spark, web.url_path(F.lit(url))) == path


def test_url_parameter(spark):
    plain = F.lit("http://shop.example.com/milky?utm_medium=organic")
    both = F.lit("http://shop.example.com/milky?utm_medium=organic&utm_source=github")
    assert one(spark, web.url_parameter(plain, "utm_medium")) == "organic"
    assert one(spark, web.url_parameter(plain, "utm_source")) is None
    assert one(spark, web.url_parameter(both, "utm_source")) == "github"
    assert one(spark, web.url_parameter(F.lit("h?a=&b=1"), "a")) is None
    assert one(spark, web.url_parameter(F.lit("h?xa=2#t"), "a")) == "2#t"
