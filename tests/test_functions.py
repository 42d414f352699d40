"""Scalar rules on hand-made edge rows (known values)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import codes as C
from tessera.functions import dates as D


def one_col(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_pad_lenient_and_strict(spark):
    vals = ["1", " 01 ", "12345", "123456", "12a", ""]
    assert one_col(spark, vals, lambda c: C.pad_id(c, 5)) == ["00001", "00001", "12345", "123456", "12a", ""]
    assert one_col(spark, vals, lambda c: C.pad_id_strict(c, 5)) == ["00001", "00001", "12345", None, None, None]


def test_segment_pad(spark):
    vals = ["0517-0801-25", "12345-678-90", "12345-6789-0", "bad", "123456-1-1", "1-2"]
    assert one_col(spark, vals, lambda c: C.segment_pad(c, (5, 4, 2))) == [
        "00517080125", "12345067890", "12345678900", None, None, None]
    assert one_col(spark, ["0002-7510"], lambda c: C.segment_pad(c, (5, 4))) == ["000027510"]


def test_dotted_codes(spark):
    assert one_col(spark, ["U071", " j18.9 ", "a00", ""], lambda c: C.dotted(c, 3)) == ["U07.1", "J18.9", "A00", ""]
    assert one_col(spark, ["25000", "V3000", "E8120", "460"], lambda c: C.dotted(c, 3, e_category_len=4)) == [
        "250.00", "V30.00", "E812.0", "460"]
    assert one_col(spark, ["0001", "470", "47"], lambda c: C.dotted(c, 2, upper=False)) == ["00.01", "47.0", "47"]


def test_format_patterns(spark):
    assert one_col(spark, ["250.00", "V30.00", "E812.0", "E812.00"], lambda c: C.matches(c, "icd9cm")) == [
        True, True, True, False]


def test_verhoeff_known_values(spark):
    vals = ["73211009", "73211008", "12x", "012345", "1234"]
    assert one_col(spark, vals, C.verhoeff_valid) == [True, False, False, False, False]


def test_positional_decode(spark):
    df = spark.createDataFrame([("G010", "state"), ("G0100010", "county"), ("G0100010020100", "tract"),
                                ("G12345", "zcta"), ("GX100", "state"), ("G010", "block"), ("010", "state")],
                               "k string, lvl string")
    out = [r[0] for r in df.select(C.positional_decode(F.col("k"), F.col("lvl"))).collect()]
    assert out == ["01", "01001", "01001020100", "12345", None, None, None]


def test_secondary_code_rules(spark):
    vals = ["10", "1.1", "99", "99.0", " 7.2 ", "1.0"]
    assert one_col(spark, vals, C.secondary_code) == ["10.0", "1.1", "99", "99", "7.2", "1.0"]
    assert one_col(spark, ["10", "1.0", "99.0"], C.primary_code) == [10, 1, 99]


def test_name_key_accents(spark):
    vals = ["Côte-d'Or", "Cote d Or", "  ", "São Paulo!!"]
    assert one_col(spark, vals, C.name_key) == ["cote d or", "cote d or", None, "sao paulo"]


def test_labels_flags_tags(spark):
    assert one_col(spark, ["Active", "Non-US", "Never Active"], C.snake_label) == ["active", "non_us", "never_active"]
    assert one_col(spark, ["Y", " y", "N", ""], C.yn_bool) == [True, True, False, False]
    assert one_col(spark, ["Diabetes mellitus (disorder)", "No tag here"], C.trailing_tag) == ["disorder", ""]
    assert one_col(spark, ["domain:x", "nocolon", ":v", "ns:"], C.tag_namespace) == ["domain", None, None, None]


def test_nullish_and_numbers(spark):
    vals = ["1,234.5", "n/a", "", ".", "NaN", "abc", "7"]
    assert one_col(spark, vals, C.lenient_double) == [1234.5, None, None, None, None, None, 7.0]


@pytest.mark.parametrize("day,expected", [
    (dt.date(2023, 1, 1), (2023, 1)), (dt.date(2020, 12, 31), (2020, 53)), (dt.date(2021, 1, 2), (2020, 53)),
    (dt.date(2021, 1, 3), (2021, 1)), (dt.date(2024, 12, 28), (2024, 52)), (dt.date(2025, 12, 31), (2025, 53)),
])
def test_epi_week_known_values(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d date")
    r = df.select(D.epi_year("d"), D.epi_week("d")).first()
    assert (r[0], r[1]) == expected


def test_epi_weeks_per_year(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        F.explode(F.sequence(F.lit(dt.date(2013, 12, 1)), F.lit(dt.date(2026, 1, 31)), F.expr("INTERVAL 1 DAY"))).alias("d"))
    weeks = {r[0]: r[1] for r in df.groupBy(D.epi_year("d").alias("y")).agg(F.max(D.epi_week("d"))).collect()}
    assert weeks[2014] == 53 and weeks[2020] == 53 and weeks[2025] == 53 and weeks[2024] == 52


def test_safe_date(spark):
    vals = ["20240115", "", "20241340", "bad"]
    assert one_col(spark, vals, lambda c: D.safe_date(c, "yyyyMMdd")) == [dt.date(2024, 1, 15), None, None, None]
    assert one_col(spark, ["3/20/2011", "13/1/2000"], lambda c: D.safe_date(c, "M/d/yyyy")) == [dt.date(2011, 3, 20), None]


def test_year_window_resolution():
    assert D.build_years(2000, 2001, this_year=2026) == (2000, 2001)
    assert [D.build_years(back=n, this_year=2026) for n in (0, 1, 3)] == [(2026, 2026), (2025, 2026), (2023, 2026)]
    for kwargs in ({"first": 2000}, {"first": 2002, "last": 2001}, {"first": 2000, "last": 2001, "back": 2}, {}, {"back": -1}):
        with pytest.raises(ValueError):
            D.build_years(this_year=2026, **kwargs)


def test_strip_range_suffix(spark):
    vals = ["Certain infectious diseases (A00-B99)", "Neoplasms (C00-D49) ", "Tumors (C7A)", "No range here", "Odd (x)"]
    assert one_col(spark, vals, C.strip_range_suffix) == [
        "Certain infectious diseases", "Neoplasms", "Tumors", "No range here", "Odd (x)"]


def test_long_texts_are_not_cut(spark):
    tail = "9" * 1_100_000
    assert one_col(spark, ["G" + tail], lambda x: C.positional_decode(x, F.lit("state"))) == [None]
    assert one_col(spark, ["A00" + tail], C.dotted) == ["A00." + tail]
    assert one_col(spark, ["10." + tail, "x"], C.secondary_code) == ["10." + tail, None]
    assert one_col(spark, ["ns:" + tail], C.tag_value) == [tail]


def test_name_key_of_every_decomposable_character(spark):
    import unicodedata
    chars = [chr(i) for i in range(0xA1, 0x1F700) if not 0xD800 <= i < 0xE000 and (unicodedata.decomposition(chr(i)) or unicodedata.combining(chr(i)))]
    vals = [f"a{c}b" for c in chars] + ["İstanbul", "ﬁord", "Ａｂｃ", "Bavīria", "．", "e\u0301\u0302"]

    def want(v):
        kept = [c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)]
        return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in "".join(kept).lower()).split()) or None

    assert one_col(spark, vals, C.name_key) == [want(v) for v in vals]


def test_clean_text_and_month_lengths(spark):
    assert one_col(spark, [" x ", "N/A", "", None, "none"], C.clean_text) == ["x", None, None, None, None]
    days = one_col(spark, [dt.date(2024, 2, 10), dt.date(2023, 2, 1), dt.date(2024, 12, 31)], D.days_in_month, "date")
    assert days == [29, 28, 31]
    assert one_col(spark, [2024, 2023], D.days_in_year, "int") == [366, 365]
