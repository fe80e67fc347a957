"""Column expressions: codes, name key, hashes, dates."""

import datetime as dt
import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from hydromart import functions as fn


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first().y


@pytest.mark.parametrize("name,key", [
    ("Saint-Chély-d'Apcher", "saintchelydapcher"), ("L'Île-Bouchard", "lilebouchard"),
    ("Château  Renault", "chateaurenault"), ("ÄÇÈÉÊÍÑÓÖÜ", "aceeeinoou")])
def test_place_key(spark, name, key):
    assert one(spark, fn.place_key("x"), name) == key


def test_place_key_matches_unicode_nfd_on_latin_letters(spark):
    letters = "".join(chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha())

    def ref(s):
        return "".join(ch for ch in unicodedata.normalize("NFD", s)
                       if not unicodedata.category(ch).startswith("M")).lower()
    assert one(spark, F.lower(fn.strip_marks("x")), letters) == ref(letters)


@pytest.mark.parametrize("v,out", [("1", "01"), ("2a", "2A"), ("2B", "2B"), ("971", "97"), (" 37 ", "37")])
def test_department_code(spark, v, out):
    assert one(spark, fn.department_code("x"), v) == out


def test_pad_code_truncates_long_values(spark):
    assert one(spark, fn.pad_code("x", 5), " 1234 ") == "01234"
    assert one(spark, fn.pad_code("x", 5), "123456") == "12345"


def test_int_text_of_float_department(spark):
    assert one(spark, fn.int_text("x", 2), 7.0, "x double") == "07"
    assert one(spark, fn.int_text("x", 2), "2A") is None


def test_identity_hash_matches_md5(spark):
    got = one(spark, fn.identity_hash("x", F.lit("2026-10-01"), F.lit("HIXnJ")), "S1")
    assert got == hashlib.md5(b"S1|2026-10-01|HIXnJ").hexdigest()
    assert one(spark, fn.identity_hash("x", F.lit("d")), None) is None
    assert one(spark, fn.identity_hash(F.lit("d"), "x", null_as_empty=True), None) == hashlib.md5(b"d|").hexdigest()


@pytest.mark.parametrize("ts,expected", [
    (dt.datetime(1899, 12, 31), None), (dt.datetime(1900, 1, 1), dt.date(1900, 1, 1)), (None, None)])
def test_sentinel_dates(spark, ts, expected):
    assert one(spark, fn.sentinel_date("x"), ts, "x timestamp") == expected


def test_sunday_week_matches_strftime_u(spark):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(0, 9000, 7)] + [dt.date(2026, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(fn.sunday_week("d").alias("w")).collect()]
    assert got == [int(d.strftime("%U")) for d in days]


def test_safe_ratio_and_safe_cast(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r.r for r in df.select(fn.safe_ratio("a", "b").alias("r")).collect()] == [None, None, 0.5]
    assert one(spark, fn.safe_cast("x", "date"), "invalide") is None


def test_valid_label_row(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("Code_INSEE",), ("37001",)], "x string")
    assert [r.x for r in df.where(fn.valid_label_row("x", "Code_INSEE")).collect()] == ["37001"]
