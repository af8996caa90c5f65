"""Season points, season ranking and champions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_row_number
from seasonstats.schema import MODES

# Points level at the end of a season are decided by the lower driverid, so that results repeat.


def _best_first():
    return [F.desc_nulls_last("totalpoints"), F.asc_nulls_last("driverid")]


def season_points(results: DataFrame) -> DataFrame:
    return (
        results.where(F.col("mode").isin(*MODES.values()))
        .groupBy(F.col("year").cast("long").alias("year"), "driverid")
        .agg(F.sum("points").alias("totalpoints"))
    )


def season_ranking(results: DataFrame) -> DataFrame:
    """Full ranking of every season. A season may have any number of competitors: it is ranked in blocks."""
    return with_row_number(season_points(results), ["year"], _best_first(), "rankdriver").drop("rankdriver_all")


def champions(results: DataFrame) -> DataFrame:
    """First of every season, of unfinished seasons as well.

    Every task keeps its own best row per season before the shuffle (``WindowGroupLimit``), so one season with
    very many competitors does not gather them.
    """
    first = F.row_number().over(Window.partitionBy("year").orderBy(*_best_first()))
    return season_points(results).withColumn("rankdriver", first.cast("long")).where("rankdriver = 1")
