"""Small inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from touchline import functions as fn
from touchline.operators import checks, relations


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_width_bucket(rows):
    data = [(190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3), (510000.0, 4), (610000.0, 5)]
    df = rows(data, "amount double, expected int")
    got = df.select(fn.width_bucket(F.col("amount"), F.lit(200000.0), F.lit(600000.0), F.lit(4)).alias("b"), "expected")
    assert all(r["b"] == r["expected"] for r in got.collect())


def test_surrogate_key(rows):
    data = [
        ("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        (None, None, None, "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]
    df = rows(data, "a string, b string, c string, one string, every string")
    cols = [F.col(c) for c in "abc"]
    got = df.select(fn.surrogate_key(cols[0]).alias("k1"), "one", fn.surrogate_key(*cols).alias("k3"), "every")
    for r in got.collect():
        assert (r["k1"], r["k3"]) == (r["one"], r["every"])


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", ""),
        ("http://witanddelight.com/2018/01/tips/?utm_source=google", "witanddelight.com", "2018/01/tips/"),
        ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog"),
        ("android-app://m.facebook.com/", "m.facebook.com", None),
        ("https://m.facebook.com/", "m.facebook.com", ""),
    ],
)
def test_urls(spark, url, host, path):
    assert one(spark, fn.get_url_host(F.lit(url))) == host
    if path is not None:
        assert one(spark, fn.get_url_path(F.lit(url))) == path


def test_url_parameter(spark):
    url = F.lit("http://drewbanin.com/milky?utm_medium=organic&utm_source=github&empty=")
    assert one(spark, fn.get_url_parameter(url, "utm_medium")) == "organic"
    assert one(spark, fn.get_url_parameter(url, "utm_source")) == "github"
    assert one(spark, fn.get_url_parameter(url, "empty")) is None
    assert one(spark, fn.get_url_parameter(url, "other")) is None


def test_haversine(spark):
    args = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert int(one(spark, fn.haversine_distance(*args))) == 267
    assert int(one(spark, fn.haversine_distance(*args, unit="km"))) == 430
    with pytest.raises(ValueError):
        fn.haversine_distance(*args, unit="m")


def test_null_safe_arithmetic(rows):
    df = rows([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    cols = [F.col(c) for c in "abc"]
    got = [tuple(r) for r in df.select(fn.safe_add(*cols), fn.safe_subtract(*cols)).collect()]
    assert got == [(6, 0), (7, 1), (2, -2), (0, 0)]
    pairs = rows([(6, 0), (10, 5), (None, None), (0, None), (0, 5)], "n int, d int")
    assert [r[0] for r in pairs.select(fn.safe_divide(F.col("n"), F.col("d"))).collect()] == [None, 2.0, None, None, 0.0]


@pytest.mark.parametrize(
    "text, value",
    [
        ("€10.50m", 10500000), ("€ 900k", 900000), ("€1,5m", 1500000), ("1234", 1234), ("-", None), ("", None),
        (None, None), ("\xa0€20m\xa0", 20000000), ("1.2.3m", None), ("mystery", None),
    ],
)
def test_market_value(spark, text, value):
    assert one(spark, fn.parse_market_value(F.lit(text))) == value


@pytest.mark.parametrize(
    "text, fee, shown",
    [
        ("free transfer", 0, "free transfer"), ("Loan fee: €1m", 0, "Loan fee: €1m"), (" - ", 0, "-"), ("?", None, "?"),
        ("€3m", 3000000, "€3m"), ("", None, None), (None, None, None),
    ],
)
def test_fee(spark, text, fee, shown):
    got = one(spark, fn.parse_fee(F.lit(text)))
    assert (got["fee_eur"], got["fee_text"]) == (fee, shown)


@pytest.mark.parametrize(
    "text, code",
    [("2425", "2425"), ("2024/25", "2425"), ("2024-25", "2425"), ("2024", "2425"), (" 9900 ", "9900"), ("x", "x"), (None, None), ("2099", "9900")],
)
def test_normalize_season(spark, text, code):
    assert one(spark, fn.normalize_season(F.lit(text))) == code


def test_seasons(spark):
    day = F.lit(dt.date(2024, 8, 1))
    assert one(spark, fn.season_of_date(day)) == "2425"
    assert one(spark, fn.season_of_date(F.lit(dt.date(2024, 7, 31)))) == "2324"
    assert one(spark, fn.season_of_date(F.lit(dt.date(1999, 12, 1)))) == "9900"
    assert one(spark, fn.season_codes(F.lit(2022), day)) == ["2223", "2324", "2425"]
    assert one(spark, fn.recent_season_codes(day, 2)) == ["2324", "2425"]
    assert one(spark, fn.season_to_years(F.lit("9900"))) == "1999-2000"
    assert one(spark, fn.season_label(F.lit("2425"))) == "2024/25"


def test_numbers_in_text(spark):
    assert one(spark, fn.to_float(F.lit(" 1,234.5 "))) == 1234.5
    assert one(spark, fn.to_float(F.lit("1.5f"))) is None
    assert one(spark, fn.to_float(F.lit("NaN"))) is None
    assert one(spark, fn.parse_age(F.lit("02/10/1992 (32)"))) == 32
    assert one(spark, fn.parse_age(F.lit("02/10/1992"))) is None


def test_slugify(spark):
    assert one(spark, fn.slugify(F.lit("!Hell0 world-hi"))) == "hell0_world_hi"
    assert one(spark, fn.slugify(F.lit("0Hell0 world-hi"))) == "_0hell0_world_hi"


def test_links(spark):
    assert one(spark, fn.profile_id(F.lit("https://x.example.com/mo-salah/profil/spieler/148455"))) == "148455"
    assert one(spark, fn.profile_slug(F.lit("/mo-salah/profil/spieler/148455"))) == "mo-salah"
    assert one(spark, fn.profile_id(F.lit("/only"))) == ""
    assert one(spark, fn.profile_id(F.lit(None).cast("string"))) == ""
    assert one(spark, fn.normalize_url(F.lit("//x/y"))) == "https://x/y"
    none = F.lit(None).cast("string")
    assert one(spark, fn.first_srcset_url(none, F.lit("//a/b.jpg 1x, //c/d.jpg 2x"), none, F.lit("e"))) == "https://a/b.jpg"


def test_deduplicate(rows):
    df = rows([(1, "play", 1), (1, "play", 2), (2, "pause", 1), (None, "x", 1), (None, "y", 3)], "u int, e string, v int")
    got = relations.deduplicate(df, ["u"], [F.col("v").desc()])
    assert values(got) == values(rows([(1, "play", 2), (2, "pause", 1), (None, "y", 3)], "u int, e string, v int"))


def test_pivot(rows):
    df = rows([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    quoted = relations.pivot(df, ["size"], "color", ["red", "blue", "blue's"])
    assert quoted.columns == ["size", "red", "blue", "blue's"]
    slugs = relations.pivot(df, ["size"], "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert slugs.columns == ["size", "red", "blue", "blues"]
    assert values(slugs) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_unpivot_boolean(rows):
    data = [(123, "2017-01-01", "active", "tier 1", True), (567, "2017-03-01", "churned", "tier 2", None)]
    df = rows(data, "customer_id int, created_at string, status string, segment string, is_updated boolean")
    got = relations.unpivot(df, ["customer_id", "created_at"], field_name="prop", value_name="val")
    assert ("prop" in got.columns) and values(got, "customer_id", "prop", "val") == sorted(
        [(123, "status", "active"), (123, "segment", "tier 1"), (123, "is_updated", "true"),
         (567, "status", "churned"), (567, "segment", "tier 2"), (567, "is_updated", None)], key=repr)


def test_union_relations(rows):
    a = rows([(1, "drew", 1), (2, "bob", None), (3, "alice", 4)], "id int, name string, favorite_number int")
    b = rows([(1, "red", 8), (2, "blue", 9)], "id int, favorite_color string, favorite_number int")
    got = relations.union_relations({"a": a, "b": b}, source_col=None)
    assert got.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert got.count() == 5
    assert relations.union_relations({"a": a, "b": b}, exclude=["NAME"], where="id = 1").columns == [
        "_source_relation", "id", "favorite_number", "favorite_color"]
    with pytest.raises(ValueError):
        relations.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        relations.union_relations({"a": a}, include=["nothing"])


def test_spines(spark):
    days = relations.date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    assert days.count() == 9
    months = relations.date_spine(spark, "month", dt.date(2018, 1, 15), dt.date(2018, 3, 20))
    assert [str(r[0].date()) for r in months.collect()] == ["2018-01-15", "2018-02-15"]
    assert relations.date_spine(spark, "week", dt.date(2024, 1, 6), dt.date(2024, 1, 7)).count() == 1
    assert relations.date_spine(spark, "hour", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 5, 30)).count() == 5
    assert relations.date_spine(spark, "day", dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0
    assert relations.generate_series(spark, 10).count() == 10
    with pytest.raises(ValueError):
        relations.generate_series(spark, 0)


def test_star_and_values(rows, spark):
    df = rows([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*relations.star(df, ["FIELD_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    v = rows([("a", "left"), ("b", "right"), ("c", "left"), ("g", "left"), ("g", "left")], "field string, condition string")
    assert [r[0] for r in relations.column_values(v, "field").collect()][0] == "g"
    left = relations.column_values(v, "field", where="condition = 'left'")
    assert values(left) == [("a",), ("c",), ("g",)]
    empty = v.where("field = 'zz'").select("field")
    assert spark.range(1).select(relations.single_value(empty, "none")).first()[0] == "none"
    assert spark.range(1).select(relations.single_value(empty)).first()[0] is None
    assert spark.range(1).select(relations.single_value(v.where("field = 'a'"), "none")).first()[0] == "a"


def test_union_by_pattern(rows, spark):
    for day in (1, 2):
        rows([(day, "play")], "user_id int, event string").createOrReplaceTempView(f"golden_2018010{day}")
    assert relations.union_by_pattern(spark, "golden_%").count() == 2
    assert relations.union_by_pattern(spark, "GOLDEN_%", exclude="%2").count() == 1
    with pytest.raises(ValueError):
        relations.union_by_pattern(spark, "no_such_%")


def test_ranges(rows):
    flat = rows([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    for gaps, failing in (("not_allowed", 0), ("allowed", 0), ("required", 2)):
        assert checks.check_ranges_exclusive(flat, "lo", "hi", gaps=gaps).count() == failing
    zero = rows(
        [(3, "2020-05-06", "2020-05-07"), (3, "2020-05-08", "2020-05-10"), (3, "2020-05-08", "2020-05-08"),
         (3, "2020-05-12", "2020-05-15"), (4, "2020-06-06", "2020-06-07"), (4, "2020-06-08", "2020-06-08")],
        "id int, a string, b string",
    ).select("id", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    assert checks.check_ranges_exclusive(zero, "a", "b", "id", zero_length=True).count() == 0
    assert checks.check_ranges_exclusive(zero, "a", "b", "id").count() == 2
    with pytest.raises(ValueError):
        checks.check_ranges_exclusive(flat, "lo", "hi", gaps="some")


def test_sequences(rows):
    even = rows([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "g int, n int")
    assert checks.check_sequential_values(even, "n", 2).count() == 0
    assert checks.check_sequential_values(even, "n", 2, group_by=["g"]).count() == 0
    assert checks.check_sequential_values(even, "n", 1).count() == 4
    hours = rows([(f"2021-01-01 0{h}:00",) for h in range(4)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert checks.check_sequential_values(hours, "t", 1, "hour").count() == 0


def test_equality(rows):
    a = rows([(1, 1, 3), (1, 2, 1), (2, 3, 3)], "col_a int, col_b int, col_c int")
    b = rows([(1, 1, 2), (1, 2, 2), (2, 3, 2)], "col_a int, col_b int, col_c int")
    assert checks.check_equality(a, b, columns=["col_a", "col_b"]).count() == 0
    assert checks.check_equality(a, b, exclude=["COL_C"]).count() == 0
    assert checks.check_equality(a, b).count() == 6
    near_a = rows([(1, 0.12345678)], "id int, x double")
    near_b = rows([(1, 0.12344999)], "id int, x double")
    assert checks.check_equality(near_a, near_b, precision=4).count() == 2
    assert checks.check_equality(near_a, near_b, precision=3).count() == 0
    with pytest.raises(ValueError):
        checks.check_equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        checks.check_equality(a, b, ["col_a"], ["col_b"])


def test_small_checks(rows):
    df = rows([(1, None, "a"), (1, None, ""), (2, 5, " ")], "g int, v int, s string")
    assert checks.check_at_least_one(df, "v").count() == 0
    assert checks.check_at_least_one(df, "v", ["g"]).count() == 1
    assert checks.check_at_least_one(df.where("g = 9"), "v").count() == 1
    assert checks.check_not_empty_string(df, "s").count() == 2
    assert checks.check_not_empty_string(df, "s", trim=False).count() == 1
    assert checks.check_not_null_proportion(df, "v", 0.3).count() == 0
    assert checks.check_not_null_proportion(df, "v", 0.5).count() == 1
    assert checks.check_not_null_proportion(df.where("g = 9"), "v", 0.5).count() == 0
    assert checks.check_not_constant(df, "g").count() == 0
    assert checks.check_not_constant(df, "g", ["g"]).count() == 2
    assert checks.check_accepted_range(df, "v", 6).count() == 1
    assert checks.check_expression(df, "v > 3").count() == 0
    assert checks.check_expression(df, "> 1", "g").count() == 2
    assert checks.check_unique_combination(df, ["g", "v"]).count() == 1
    assert checks.check_fresh(df.where("g = 9").select(F.lit(None).cast("timestamp").alias("t")), "t").count() == 1
    now = F.lit(dt.datetime(2024, 1, 10)).cast("timestamp")
    old = rows([("2024-01-08 12:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert checks.check_recency(old, "t", "day", 1, now).count() == 1
    assert checks.check_recency(old, "t", "day", 2, now).count() == 0
    assert checks.check_recency(old, "t", "day", 2, now, date_only=True).count() == 0
    assert checks.check_columns_match(df, ["G", "v", "s"]).count() == 0
    assert checks.check_columns_match(df, ["g", "v", "x"]).count() == 2


def test_run_checks_statuses(rows, spark):
    df = rows([(1, None), (2, 5)], "g int, v int")

    specs = [
        checks.Check("a", "t", df, lambda d: checks.check_not_null(d, "v")),
        checks.Check("b", "t", df, lambda d: checks.check_not_null(d, "v"), severity="warn"),
        checks.Check("c", "t", df, lambda d: checks.check_not_null(d, "v"), error_if="> 1", warn_if="> 0"),
        checks.Check("d", "t", df, lambda d: checks.check_not_null(d, "g"), error_if="< 1"),
        checks.Check("e", "t", df, lambda d: checks.check_not_null(d, "v"), where="g = 2"),
        checks.Check("f", "t", df.where("g = 9"), lambda d: checks.check_not_null(d, "v"), warn_when_empty=True),
        checks.Check("g", "t", lambda: spark.read.parquet("/no/such/table"), lambda d: d),
        checks.Check("h", "t", df, lambda d: checks.check_equal_rowcount(d, d.where("g = 1")), failures=checks.sum_of("diff_count")),
    ]
    got = {r["check"]: (r["failures"], r["status"]) for r in checks.run_checks(spark, specs).collect()}
    assert got == {
        "a": (1, "fail"), "b": (1, "warn"), "c": (1, "warn"), "d": (0, "fail"), "e": (0, "pass"), "f": (0, "warn"),
        "g": (None, "unreadable"), "h": (1, "fail"),
    }
