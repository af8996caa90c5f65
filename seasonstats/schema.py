"""Shape of the results table: one row per competitor per session."""

from __future__ import annotations

from pyspark.sql import types as T

RESULTS = T.StructType(
    [
        T.StructField("year", T.LongType()),
        T.StructField("roundnumber", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("driverid", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("position", T.DoubleType()),
        T.StructField("gridposition", T.DoubleType()),
        T.StructField("points", T.DoubleType()),
        T.StructField("officialeventname", T.StringType()),
        T.StructField("eventname", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

# Landed files also say when they were landed, so that a corrected session can replace the old one.
LANDED = T.StructType([*RESULTS.fields, T.StructField("landed_at", T.TimestampType())])

SESSION_KEY = ["year", "roundnumber", "mode"]

# Session modes by the letter used in file names. Fixed values.
MODES = {"R": "Race", "S": "Sprint"}

RACE, SPRINT = MODES["R"], MODES["S"]
