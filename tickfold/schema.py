"""Declared schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# They decide the results and must not change.
QUALIFIER_WORD = "sensor"       # removed from a column qualifier to get the sensor id
PAGE_SIZE = 100                 # source rows per page
RUN_LENGTH = 10                 # readings per run, and the divisor of a run's mean
MIN_PAGE_ROWS = 10              # a smaller page waits for more data
MAX_BATCHES = 50                # counted batches per start
HWM_PAD_MS = 999                # added to a watermark that was stored as whole seconds
IDLE_POLL = "5 seconds"         # pause between polls of a source without enough data
DATE_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Keys are epoch milliseconds of 13 digits (2001-09-09 to 2286-11-20).
MAX_KEY_MS = 9_999_999_999_999

SINK_SCHEMA = T.StructType(
    [
        T.StructField("date", T.TimestampType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("sensor_id", T.IntegerType(), True),
    ]
)

#: The tables of a sink with a log: records and what did not become one.
LOGGED_SCHEMAS = {
    "records": SINK_SCHEMA,
    "rejects": T.StructType([*SINK_SCHEMA.fields, T.StructField("reason", T.StringType(), True)]),
    "bad_cells": T.StructType(
        [
            T.StructField("row_key", T.StringType(), True),
            T.StructField("qualifier", T.StringType(), True),
            T.StructField("cell", T.StringType(), True),
            T.StructField("reason", T.StringType(), True),
        ]
    ),
    # ``page_key`` is the last key of the page that a mean belongs to.
    "held": T.StructType(
        [
            T.StructField("page_key", T.LongType(), True),
            T.StructField("chunk_idx", T.LongType(), True),
            T.StructField("ms", T.LongType(), True),
            T.StructField("value", T.DoubleType(), True),
            T.StructField("sensor_id", T.IntegerType(), True),
        ]
    ),
}

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.IntegerType(), True),
        T.StructField("bridge_id", T.IntegerType(), True),
        T.StructField("parameter_unit", T.StringType(), True),
        T.StructField("sensor_name", T.StringType(), True),
        T.StructField("threshold", T.DoubleType(), True),
    ]
)
