"""Reading, normalising, landing and repairing result rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstats.schema import MODES, RACE, RESULTS, SESSION_KEY
from seasonstats.sources.shared import materialize

MAX_ROUND = None  # no limit


def read_results(spark: SparkSession, path: str, schema: T.StructType = RESULTS) -> DataFrame:
    """Stored results. Columns are matched without regard to case; others in the files are not read."""
    return spark.read.schema(schema).parquet(path)


def _after_epoch(count: Column, per_second: int) -> Column:
    """Timestamp without zone, in microseconds, ``count`` units after the start of 1970."""
    kept = count - F.pmod(count, F.lit(per_second // 1_000_000))
    seconds = (kept.cast("decimal(20,0)") / F.lit(per_second)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def micros_from_nanos(nanos: Column) -> Column:
    """Nanoseconds since 1970 as a timestamp without zone in microseconds; the rest is cut off."""
    return _after_epoch(nanos, 1_000_000_000)


def normalise(rows: DataFrame, schema: T.StructType = RESULTS) -> DataFrame:
    """Lower-case names, the types of ``schema``, NaN as NULL, timestamps without zone. Columns that the
    source lacks become NULL, columns that ``schema`` lacks are dropped."""
    names = {c.lower(): c for c in rows.columns}
    if len(names) < len(rows.columns):
        raise ValueError("two columns have the same name but for the case of letters")
    types = dict(rows.dtypes)
    columns = []
    for field in schema.fields:
        source = names.get(field.name)
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        if source is not None and types[source] in ("double", "float"):
            value = F.nanvl(value, F.lit(None))
        if isinstance(field.dataType, T.TimestampNTZType) and source is not None and types[source] == "timestamp":
            value = _after_epoch(F.unix_micros(value), 1_000_000)  # the UTC instant, whatever the session's zone
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def season_filter(
    rows: DataFrame,
    years: Iterable[int] | None = None,
    start: int | None = None,
    stop: int | None = None,
    modes: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the listed seasons, or of ``start`` to ``stop`` inclusive (either may be left open), in the listed modes (R, S or names)."""
    if years is not None:
        rows = rows.where(F.col("year").isin(*years))
    if start is not None:
        rows = rows.where(F.col("year") >= start)
    if stop is not None:
        rows = rows.where(F.col("year") <= stop)
    if modes is not None:
        rows = rows.where(F.col("mode").isin(*[MODES.get(m, m) for m in modes]))
    return rows


def until_date(rows: DataFrame, day: str) -> DataFrame:
    """Rows up to the end of ``day``, as a filter on the stored column that reaches the scan."""
    return rows.where(F.col("date") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"))


def file_label() -> Column:
    """Name of a session's landing file: year, round in two digits, mode letter."""
    letter = F.col("mode")
    for code, name in MODES.items():
        letter = F.when(F.col("mode") == name, code).otherwise(letter)
    return F.format_string("%d_%02d_%s.parquet", "year", "roundnumber", letter)


def landing_manifest(rows: DataFrame) -> DataFrame:
    """(year, roundnumber, mode, file, rows): the sessions in ``rows`` and the file name of each."""
    counted = rows.groupBy(*SESSION_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(*SESSION_KEY, file_label().alias("file"), "rows")


def enrich(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Copy the attributes of each session to its rows; rows of a session that is not listed stay, without them.

    Sessions are few and are stored before the join, so that their true size decides whether they are broadcast. A
    session that is listed twice is an error.
    """
    extra = [c for c in sessions.columns if c not in SESSION_KEY]
    named = sessions.select(*[F.col(k).alias(f"{k}__of") for k in SESSION_KEY], *extra)
    stored = materialize(named, "sessions")
    keys = [f"{k}__of" for k in SESSION_KEY]
    if stored.groupBy(*keys).count().where("`count` > 1").limit(1).count():
        raise ValueError("a session is listed twice")
    same = F.lit(True)
    for k in SESSION_KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__of"))
    return rows.drop(*extra).join(stored, same, "left").drop(*keys)


def land(rows: DataFrame, path: str, landed_at: Column | None = None) -> None:
    """Write whole sessions, one folder per session; a session that is landed again replaces the old one.

    Rebalancing writes a session into few files, and splits a session that is too large for one task.
    """
    stamped = rows.withColumn("landed_at", F.current_timestamp() if landed_at is None else landed_at)
    (
        stamped.hint("rebalance", *[F.col(k) for k in SESSION_KEY])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SESSION_KEY)
        .parquet(path)
    )


def latest_by_key(rows: DataFrame, key: list[str] = SESSION_KEY, landed: str = "landed_at") -> DataFrame:
    """Rows of the newest landing of every session, so a row missing from the newest landing is gone. Rows without a
    landing time count as one landing, older than all others.

    Landings are reduced to one row per session and stored; the rows are then compared with that small table
    rather than gathered by session, however many rows one session has.
    """
    newest = rows.groupBy(*key).agg(F.max(landed).alias("newest_landing"))
    newest = materialize(newest, "newest_landings").select(
        *[F.col(k).alias(f"{k}__of") for k in key], "newest_landing"
    )
    same = F.col(landed).eqNullSafe(F.col("newest_landing"))
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__of"))
    return rows.join(newest, same, "left_semi")


def contiguous_rounds(rows: DataFrame, max_round: int | None = MAX_ROUND) -> DataFrame:
    """Rows of the rounds before the first round without a race in their season, up to ``max_round`` if given."""
    held = (F.col("mode") == RACE) & (F.col("roundnumber") >= 1)
    if max_round is not None:
        held = held & (F.col("roundnumber") <= max_round)
    races = rows.where(held).select("year", "roundnumber").distinct()
    number = F.row_number().over(Window.partitionBy("year").orderBy("roundnumber"))
    complete = races.withColumn("nth", number).where(F.col("roundnumber") == F.col("nth")).drop("nth")
    return rows.join(materialize(complete, "complete_rounds"), ["year", "roundnumber"], "left_semi")
