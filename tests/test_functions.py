"""Truth tables of the functions whose meaning differs from Spark's defaults."""

from datetime import date, datetime

from pyspark.sql import functions as F

from sparkmart import functions as S


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).collect()[0])


def d(s):
    return F.lit(s).cast("timestamp_ntz")


def test_boundary_diff(spark):
    assert one(
        spark, S.boundary_diff("month", d("2024-01-31"), d("2024-02-01")), S.boundary_diff("week", d("2024-01-06"), d("2024-01-08")),
        S.boundary_diff("week", d("2024-01-07"), d("2024-01-07")), S.boundary_diff("year", d("2023-12-31"), d("2024-01-01")),
        S.boundary_diff("quarter", d("2024-03-31"), d("2024-04-01")), S.boundary_diff("hour", d("2024-01-01 10:59:59"), d("2024-01-01 11:00:00")),
        S.boundary_diff("day", d("2024-01-02 00:00:01"), d("2024-01-01 23:59:59"))) == (1, 1, 0, 1, 1, 1, -1)


def test_null_rules(spark):
    null = F.lit(None).cast("int")
    assert one(spark, S.least_strict(F.lit(1), null), S.least_strict(F.lit(1), F.lit(0)), S.greatest_strict(F.lit(1), null), S.div0(F.lit(4), F.lit(0)), S.div0(F.lit(4), F.lit(8)),
               S.div0(null, F.lit(0)), S.div_null(F.lit(4), F.lit(0)), S.null_negative(F.lit(-1)), S.flag_positive(null)) == (None, 0, None, 0.0, 0.5, None, None, None, 0)
    assert one(spark, S.null_or_missing(null.cast("string"), "x"), S.null_or_missing(F.lit("Missing y"), "x"), S.null_or_missing(F.lit("a"), "x")) == ("Missing x", "Missing x", "a")
    assert one(spark, S.decode(null, [(None, "n"), (1, "one")], "else"), S.decode(F.lit(1), [(2, "two")], "else")) == ("n", "else")


def test_keys(spark):
    null = F.lit(None).cast("string")
    assert one(spark, S.keyed_null(null)) == ("6bb61e3b7bce0931da574d19d1d82c88",)
    assert one(spark, S.surrogate_key(F.lit(1), null, F.lit("a"))) == one(spark, F.md5(F.lit("1--a")))
    assert one(spark, S.date_id(d("2024-02-29")), S.date_id_tz(d("2024-01-01 07:59:59")), S.date_id_tz(d("2024-01-01 08:00:00"))) == (20240229, 20231231, 20240101)


def test_id15to18(spark):
    def check(s):
        out = ""
        for block in (s[0:5], s[5:10], s[10:15]):
            out += "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"[sum(1 << i for i, ch in enumerate(block) if "A" <= ch <= "Z")]
        return s + out

    for s in ("001610000111bA3", "abcdefghijklmno", "ABCDEFGHIJKLMNO", "a1B2c3D4e5F6g7H"):
        assert one(spark, S.id15to18(F.lit(s))) == (check(s),)
    assert one(spark, S.id15to18(F.lit("short")), S.id15to18(F.lit("123456789012345678")), S.id15to18(F.lit(None).cast("string"))) == ("short", "123456789012345678", None)


def test_text(spark):
    assert one(spark, S.rlike_full(F.lit("abc"), "b"), S.rlike_full(F.lit("abc"), "a.c|x")) == (False, True)
    assert one(spark, S.slugify(F.lit("A-S || B  c"))) == ("a-s|b-c",)
    assert one(spark, S.regexp_to_array(F.lit(None).cast("string"), "a"), S.regexp_to_array(F.lit("banana"), "an")) == ([], ["an", "an"])
    assert one(spark, S.crc32_text(F.lit("123456789"))) == (0xCBF43926,)
    ips = [S.ipv4_number(F.lit(x)) for x in ("1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "a.b.c.d")]
    assert one(spark, *ips) == (16909060, 4294967295, None, None, None)
    first, last = S.split_name(F.lit(" Ada Maria Lovelace "))
    assert one(spark, first, last) == ("Ada", "Maria Lovelace")
    first, last = S.split_name(F.lit("Ada"))
    assert one(spark, first, last) == ("Ada", "")
    assert one(spark, *S.version_parts(F.lit("14.0.0-pre")).values()) == ("14.0.0", True, 14, 0, "14.0", 1400)
    assert one(spark, S.path_first(F.lit("a.b.c")), S.path_last(F.lit("a.b.c")), S.path_to_column(F.lit("a.b.c"))) == ("a", "c", "a_b_c")


def test_calendar_edges(spark):
    from sparkmart.operators import calendar as C
    bounds = spark.range(1).select(F.lit("2019-12-25").cast("date").alias("a"), F.lit("2021-02-01").cast("date").alias("b"))
    dim = {r["date_day"]: r for r in C.date_dim(C.date_spine(bounds, "a", "b")).collect()}
    assert len(dim[date(2020, 2, 29)]) == 50
    leap = dim[date(2020, 2, 29)]
    assert (leap["fiscal_year"], leap["fiscal_quarter"], leap["fiscal_quarter_name_fy"], leap["days_in_month_count"]) == (2021, 1, "FY21-Q1", 29)
    assert dim[date(2020, 1, 31)]["fiscal_year"] == 2020 and dim[date(2020, 1, 31)]["fiscal_quarter"] == 4
    assert dim[date(2020, 12, 27)]["week_of_year"] == 53 and dim[date(2021, 1, 3)]["week_of_year"] == 1
    assert dim[date(2019, 12, 25)]["holiday_desc"] == "Christmas Day" and not dim[date(2020, 12, 27)]["is_holiday"]
    assert dim[date(2021, 1, 31)]["day_of_fiscal_quarter_normalised"] == 90
    assert datetime(2021, 1, 31).date() == dim[date(2020, 12, 1)]["last_day_of_fiscal_quarter"]
