"""Explicit schemas: no inference pass over raw JSON."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import FEATURES

# AQI arrive as JSON numbers that may be written 42.0; read every series as
# double and cast integral ones to bigint after a check.
HOURLY = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in FEATURES]
)

RAW = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("fetch_timestamp", T.StringType()),
        T.StructField("hourly_units", T.MapType(T.StringType(), T.StringType())),
        T.StructField("hourly", HOURLY),
    ]
)

# the text of a document that is not valid JSON lands here instead of vanishing
CORRUPT = "_corrupt_record"
RAW_OR_CORRUPT = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])

MEASUREMENT = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField(
            "date",
            T.StructType([T.StructField("utc", T.StringType()), T.StructField("local", T.StringType())]),
        ),
    ]
)

LONG_FEED = T.StructType(
    [
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("results", T.ArrayType(MEASUREMENT)),
    ]
)

CURATED_COLUMNS = [
    "city",
    "latitude",
    "longitude",
    "timezone",
    "timestamp",
    *FEATURES,
    "parameter",
    "air_quality_label",
]
