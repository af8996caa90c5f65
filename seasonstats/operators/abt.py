"""Analytical base table: features with the label "is champion of the season of the reference date"."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = None, None  # all dates


def abt(features: DataFrame, champions: DataFrame, start: str | None = START, stop: str | None = STOP) -> DataFrame:
    """Feature rows with ``start <= dt_ref < stop`` (a bound that is None is open) and ``flchampion`` 1 or 0.

    There is one champion a season, at most as many as there are years: they are one small value, with which the wide feature
    rows are compared where they are; these are neither shuffled nor joined.
    """
    in_range = F.lit(True)
    if start is not None:
        champions = champions.where(F.col("year") >= dt.date.fromisoformat(start).year)
        in_range = in_range & (F.col("dt_ref") >= F.lit(start).cast("date"))
    if stop is not None:
        champions = champions.where(F.col("year") <= dt.date.fromisoformat(stop).year)
        in_range = in_range & (F.col("dt_ref") < F.lit(stop).cast("date"))
    one = F.struct(F.col("driverid").alias("winner"), F.col("year").cast("long").alias("season"))
    named = champions.where((F.col("rankdriver") == 1) & F.col("driverid").isNotNull() & F.col("year").isNotNull())
    winners = named.agg(F.collect_set(one)).scalar()
    won = F.array_contains(winners, F.struct(F.col("driverid").alias("winner"), F.year("dt_ref").cast("long").alias("season")))
    return features.where(in_range).withColumn("flchampion", F.coalesce(won, F.lit(False)).cast("long"))
