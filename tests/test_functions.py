import re

import pytest
from pyspark.sql import functions as F
from tickfold import functions as fn

TEXTS = [
    "5", "+5", "-5", "-0", "007", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "3.5", "3.", " 5", "5 ", " 5 ", "5\n", "\t5", "abc", "", "+", "-", "1e3", "0x1F", "5\x7f",
    "5\u0085", "--5", "+-5", "5L", ",5", "/5", "*5",
]


def _is_int(text):
    return bool(re.fullmatch(r"[+-]?[0-9]+", text)) and -(2**31) <= int(text) < 2**31


def test_parse_int_takes_only_sign_and_digits(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", fn.parse_int("t").alias("v")).collect()}
    assert got == {t: int(t) if _is_int(t) else None for t in TEXTS}


def test_strict_int_keeps_null_and_fails_on_bad_text(spark):
    good = spark.createDataFrame([("12",), (None,)], "t string")
    assert [r[0] for r in good.select(fn.strict_int("t")).collect()] == [12, None]
    for text in ("3.5", " 5 ", "abc"):
        bad = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception, match="not a 32-bit integer"):
            bad.select(fn.strict_int("t")).collect()


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_sensor_id_drops_every_occurrence(spark):
    assert _one(spark, fn.sensor_id_of(F.lit("sensor12sensor"))) == "12"
    assert _one(spark, fn.sensor_id_of(F.lit("temp"))) == "temp"


def test_int_div_truncates(spark):
    assert _one(spark, fn.int_div(F.lit(-15), 10)) == -1
    assert _one(spark, fn.int_div(F.lit(19), 10)) == 1


def test_dates_and_keys(spark):
    ms = 1_705_276_800_123
    stamp = F.timestamp_micros(F.lit(ms * 1000 + 999))
    assert _one(spark, fn.millis_of(stamp)) == ms
    assert _one(spark, fn.millis_of(fn.timestamp_of(F.lit(ms)))) == ms
    assert _one(spark, fn.format_date(fn.timestamp_of(F.lit(ms)))) == "2024-01-15 00:00:00"
    assert _one(spark, fn.hwm_key(F.lit(ms - 123))) == "1705276800999"
    assert _one(spark, fn.hwm_key(F.lit(ms), 0)) == str(ms)


def test_decode_bytes_and_text(spark):
    assert _one(spark, fn.decode_utf8(F.encode(F.lit("sensor1 °"), "UTF-8"))) == "sensor1 °"
    assert _one(spark, fn.decode_utf8(F.lit("17"))) == "17"
