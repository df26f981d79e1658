"""Scalar expressions. All are built-in columns, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickfold.schema import DATE_PATTERN, HWM_PAD_MS, QUALIFIER_WORD


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column | str, b: Column | int) -> Column:
    """Integer division that truncates towards zero: -15 by 10 is -1."""
    return F.call_function("div", _col(a), b if isinstance(b, Column) else F.lit(b))


def decode_utf8(c: Column | str) -> Column:
    """Bytes to text; a string column passes through unchanged."""
    return F.decode(_col(c).cast("binary"), "UTF-8")


def sensor_id_of(qualifier: Column | str) -> Column:
    """The qualifier with every occurrence of the fixed word removed."""
    return F.replace(_col(qualifier), F.lit(QUALIFIER_WORD), F.lit(""))


def parse_int(c: Column | str) -> Column:
    """Text to a 32-bit integer, NULL where it is not one.

    Only an optional sign and digits count: Spark's own cast would also accept blanks
    around the number, so the first and last characters are checked as well.
    """
    text = _col(c).cast("string")
    bare = (text >= "+") & (text < ":") & F.right(text, F.lit(1)).between("0", "9")
    return F.when(bare, text.try_cast("int"))


def strict_int(c: Column | str) -> Column:
    """Text to a 32-bit integer; any other text fails the job."""
    text = _col(c)
    fail = F.raise_error(F.concat(F.lit("not a 32-bit integer: "), text)).cast("int")
    return F.coalesce(parse_int(text), F.when(text.isNotNull(), fail))


def key_millis(row_key: Column | str) -> Column:
    """Row key text to epoch milliseconds."""
    return _col(row_key).cast("bigint")


def timestamp_of(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def millis_of(ts: Column | str) -> Column:
    """Timestamp to epoch milliseconds; finer digits are cut off."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def hwm_key(hwm: Column | str, pad_ms: int = HWM_PAD_MS) -> Column:
    """The key text that new rows must exceed, given the watermark in milliseconds."""
    return (_col(hwm) + F.lit(pad_ms)).cast("string")


def format_date(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_PATTERN)
