"""Training, test and out-of-time rows from the analytical base table.

All dates of one competitor's season stay on one side of the split. The split is decided by the md5 of
(seed, competitor, season), so it repeats exactly, in any cluster and after any lost task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstats.functions.selection import kth_smallest

LABEL = "flchampion"
ENTITY_SEASON = ["driverid", "year", LABEL]
OOT_YEAR, DROP_LAST, TRAIN_FRACTION, SEED = 2025, 5, 0.8, 42


def with_year(abt: DataFrame) -> DataFrame:
    return abt.withColumn("year", F.year("dt_ref").cast("long"))


def feature_names(abt: DataFrame) -> list[str]:
    """Everything that is not key, season, label or split."""
    return [c for c in abt.columns if c not in {"dt_ref", "driverid", "year", LABEL, "split"}]


def out_of_time(abt: DataFrame, oot_year: int = OOT_YEAR) -> DataFrame:
    """Rows of the season ``oot_year`` and of all later ones."""
    return with_year(abt).where(F.col("year") >= oot_year)


def analytics_rows(abt: DataFrame, oot_year: int = OOT_YEAR) -> DataFrame:
    return with_year(abt).where(F.col("year") < oot_year)


def _dates_from_last(rows: DataFrame) -> DataFrame:
    latest_first = Window.partitionBy("year").orderBy(F.desc("dt_ref"))
    return rows.select("year", "dt_ref").distinct().withColumn("nth", F.row_number().over(latest_first))


def calendar_trim(abt: DataFrame, oot_year: int = OOT_YEAR, drop_last: int = DROP_LAST) -> DataFrame:
    """(year, dt_ref) kept for training and testing: the last dates of a season give its label away."""
    return _dates_from_last(analytics_rows(abt, oot_year)).where(F.col("nth") > drop_last).drop("nth")


def entity_year_labels(abt: DataFrame, oot_year: int = OOT_YEAR) -> DataFrame:
    return analytics_rows(abt, oot_year).select(*ENTITY_SEASON).distinct()


def split_digest(seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("driverid"), F.col("year").cast("string")))


def split_limits(abt: DataFrame, oot_year: int = OOT_YEAR, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """(label, digest of its last training key): one row per label.

    Per label the competitor-seasons with the lowest digests train, ``round(fraction * n)`` of them exactly. The limit is
    selected by counts of digits, without an order of the keys; the wide rows are then compared with that of their label.
    """
    keys = entity_year_labels(abt, oot_year).select(LABEL, split_digest(seed).alias("digest"))
    return kth_smallest(keys, LABEL, "digest", lambda n: F.floor(n * fraction + 0.5)).withColumnRenamed("digest", "digest_limit")


def group_split(abt: DataFrame, oot_year: int = OOT_YEAR, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """(driverid, year, label, split) of every competitor-season before the out-of-time year."""
    return _assign(entity_year_labels(abt, oot_year), split_limits(abt, oot_year, fraction, seed), seed)


def _assign(rows: DataFrame, limits: DataFrame, seed: int) -> DataFrame:
    # One row per label, so the broadcast is of two rows for a 0/1 label.
    limits = limits.withColumnRenamed(LABEL, "limit_of")
    in_training = F.coalesce(split_digest(seed) <= F.col("digest_limit"), F.lit(False))
    return (
        rows.join(F.broadcast(limits), F.col(LABEL) == F.col("limit_of"), "left")
        .withColumn("split", F.when(in_training, "train").otherwise("test"))
        .drop("limit_of", "digest_limit")
    )


def training_sets(
    abt: DataFrame,
    oot_year: int = OOT_YEAR,
    drop_last: int = DROP_LAST,
    fraction: float = TRAIN_FRACTION,
    seed: int = SEED,
) -> DataFrame:
    """All rows with ``split`` train, test or oot (``oot_year`` and later). Late dates are dropped from train and test only.

    The wide rows are read once and not shuffled: limits and late dates are small and broadcast.
    """
    late = _dates_from_last(analytics_rows(abt, oot_year)).where(F.col("nth") <= drop_last)  # drop_last rows per season
    late = late.select(F.col("year").alias("late_year"), F.col("dt_ref").alias("late_date"))
    limits = split_limits(abt, oot_year, fraction, seed)
    rows = with_year(abt).where(F.col("year").isNotNull())
    is_late = (F.col("year") == F.col("late_year")) & (F.col("dt_ref") == F.col("late_date"))
    kept = rows.join(F.broadcast(late), is_late, "left_anti")
    split = _assign(kept, limits, seed)
    return split.withColumn("split", F.when(F.col("year") >= oot_year, "oot").otherwise(F.col("split")))


def label_rates(rows: DataFrame) -> DataFrame:
    """Rows and share of positive labels per split."""
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(LABEL).alias("label_rate"))


def example_rows(rows: DataFrame, n: int = 5, seed: int = SEED) -> DataFrame:
    """``n`` rows picked by digest: the example input stored with a model."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("driverid"), F.col("dt_ref").cast("string")))
    return rows.orderBy(digest).limit(n)
