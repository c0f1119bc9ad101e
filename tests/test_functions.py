"""Golden micro-fixtures for the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import dates, typed_cast
from strata.functions.hashing import raw_row_hash, row_hash
from strata.functions.text import clean_text, collapse_whitespace


def _one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_null_tokens(spark):
    out = _one(spark, clean_text("x"), [("",), (" N/A ",), ("na",), ("NULL",), ("-",), ("ok",)])
    assert out == [None, None, None, None, None, "ok"]


def test_accents_and_case(spark):
    assert _one(spark, clean_text("x"), [("Áé",), ("ÇÑ Ü",)]) == ["ae", "cn u"]


def test_whitespace_first_run_only(spark):
    assert _one(spark, clean_text("x"), [("a \t b  c",)]) == ["a b  c"]
    assert _one(spark, clean_text("x", collapse="all"), [("a \t b  c",)]) == ["a b c"]


def test_lone_tab_gives_empty(spark):
    assert _one(spark, clean_text("x"), [("\t",)]) == [""]


def test_first_run_spans_newlines(spark):
    assert _one(spark, collapse_whitespace("x"), [("a\n\nb\nc",)]) == ["a b\nc"]


def test_rounding_integer_cast(spark):
    out = _one(spark, typed_cast("x", "integer"), [("3.7",), ("1e3",), (" 5 ",), ("x",),
                                                   ("2.5",), ("-2.5",), (None,)])
    assert out == [4, 1000, 5, None, 3, -3, None]


def test_double_source_rounds_half_even(spark):
    out = _one(spark, typed_cast(F.col("x"), "integer", source_type=__import__(
        "pyspark.sql.types", fromlist=["DoubleType"]).DoubleType()),
        [(2.5,), (3.5,), (-2.5,)], "x double")
    assert out == [2, 4, -2]


def test_bad_date_is_null(spark):
    assert _one(spark, typed_cast("x", "date"), [("NULL",), ("2020-01-04",), ("",)]) == [
        None, dt.date(2020, 1, 4), None]


def test_hashes(spark):
    df = spark.createDataFrame([(1, "a", None)], "a int, b string, c string")
    r = df.select(raw_row_hash(["a", "b", "c"]).alias("r"), row_hash(["a", "b", "c"]).alias("h")).first()
    import hashlib
    assert r["r"] == hashlib.md5(b"1|a").hexdigest()
    assert r["h"] == hashlib.md5(b"1||a||<<NULL>>").hexdigest()


def test_date_attributes(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 4),), (dt.date(2021, 1, 1),),
                                (dt.date(2020, 2, 29),)], "d date")
    r = df.select(dates.date_key("d").alias("k"), dates.day_of_week("d").alias("w"),
                  dates.is_weekend("d").alias("we"), dates.month_name("d").alias("m"),
                  dates.day_name("d").alias("n"), dates.week_of_year("d").alias("iso"),
                  dates.is_month_end("d").alias("me"), dates.is_month_start("d").alias("ms"),
                  dates.key_to_date(dates.date_key("d")).alias("back")).collect()
    assert (r[0]["k"], r[0]["w"], r[0]["we"], r[0]["m"], r[0]["n"]) == (
        20200104, 5, True, "January", "Saturday")
    assert r[1]["iso"] == 53
    assert r[2]["me"] is True and r[2]["ms"] is False
    assert [x["back"] for x in r] == [dt.date(2020, 1, 4), dt.date(2021, 1, 1), dt.date(2020, 2, 29)]


def test_guarded_number_casts_equal_plain_ones(spark):
    """The guards only spare failing casts: every odd spelling gives what the plain casts give."""
    texts = [" 5 ", "5\n", "\x015\x7f", "+7", "-0", "-", "+", "", " ", "x", "٣", "1e3", "3.7", "-2.5", ".5", "5.", "1d", "1f ",
             "inf", "-Infinity", "NaN", "1_000", "0x1F", "0x1p3", "99999999999", "2147483648",
             "9223372036854775807", "9223372036854775808", "-9223372036854775809", None]
    x = F.col("x")
    number = F.when(~x.rlike(r"[dDfF]\s*$"), x.try_cast("double"))
    plain = {"double": number, **{t: F.coalesce(x.try_cast(t), F.round(number).try_cast(t)) for t in ("integer", "bigint")}}
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for name, col in plain.items():
        wrong = df.where(~typed_cast("x", name, df.schema["x"].dataType).eqNullSafe(col)).collect()
        assert wrong == [], name
