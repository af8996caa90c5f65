"""Reference dates, rounds, and which rounds are the last N at every reference date.

The calendar is the distinct (year, round, day) of the results: thousands of rows, whatever the size of the
results. Reference dates are numbered 1, 2, 3, ... in order of time, so that "from this day until the round
leaves the last N" is an interval of numbers. Results later reach their reference dates by exploding such
intervals, never by a join on ``date <= dt_ref``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seasonstats.sources.shared import materialize

FIRST_SEASON, LAST_SEASON = None, None  # all seasons
ROUND = ["year", "roundnumber"]


def in_seasons(year_start: int | None, year_stop: int | None) -> Column:
    """Whether the row has a season within the bounds; a bound that is None is open."""
    inside = F.col("year").isNotNull()
    if year_start is not None:
        inside = inside & (F.col("year") >= year_start)
    return inside if year_stop is None else inside & (F.col("year") <= year_stop)


def session_days(results: DataFrame) -> DataFrame:
    """Distinct (year, roundnumber, day). Rows without a date belong to no reference date."""
    return (
        results.select(*ROUND, F.to_date("date").alias("day")).where(F.col("day").isNotNull()).distinct()
    )


def conflicting_dates(results: DataFrame) -> DataFrame:
    """Dates that carry more than one season: the statistics take each date once, for its earliest season."""
    return (
        session_days(results)
        .groupBy("day")
        .agg(F.count_distinct("year").alias("seasons"), F.min("year").alias("first_season"))
        .where("seasons > 1")
        .withColumnRenamed("day", "dt_ref")
    )


def reference_dates(results: DataFrame, year_start: int | None = FIRST_SEASON, year_stop: int | None = LAST_SEASON) -> DataFrame:
    return (
        results.where(in_seasons(year_start, year_stop))
        .select(F.to_date("date").alias("dt_ref"), F.col("year").alias("ref_year"))
        .distinct()
    )


@dataclass(frozen=True)
class Calendar:
    """``index``: one stored row per (year, roundnumber, day) with

    * ``idx``, ``ref_year``: number and season of the reference date held on that day, if there is one;
    * ``lo``: number of the first reference date that sees the day;
    * ``season_end``: last reference date for which this season makes a competitor eligible;
    * ``end_<n>``: first reference date at which the round is no longer among the last n.
    """

    index: DataFrame
    max_season_gap: int
    windows: tuple[int, ...] = field(default=())

    @property
    def dates(self) -> DataFrame:
        """(idx, dt_ref, ref_year), one row per reference date: at most one per day of the years 1 to 9999,
        so it may always be broadcast."""
        return (
            self.index.where(F.col("idx").isNotNull())
            .groupBy("idx")
            .agg(F.min("day").alias("dt_ref"), F.min("ref_year").alias("ref_year"))
        )

    @cached_property
    def held(self) -> tuple[list[int], list[int]]:
        """Day (since 1970) and season of reference date 1, 2, 3, ...: ``dates`` as two lists, for tasks in Python."""
        found = self.dates.select("idx", F.unix_date("dt_ref").alias("day"), "ref_year").toArrow().sort_by("idx")
        return found.column("day").to_pylist(), found.column("ref_year").to_pylist()

    def eligible(self, latest_year: Column) -> Column:
        return F.col("ref_year") - latest_year <= self.max_season_gap


def _numbered_days(sessions: DataFrame, year_start: int | None, year_stop: int | None, inclusive: bool) -> DataFrame:
    # One row per day, at most 3,652,059 of them (years 1 to 9999): the window without a key is bounded.
    in_range = in_seasons(year_start, year_stop)
    days = sessions.groupBy("day").agg(F.min(F.when(in_range, F.col("year"))).alias("ref_year"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    is_ref = F.col("ref_year").isNotNull()
    number = F.count("ref_year").over(earlier) + 1
    skip_own_day = F.lit(0) if inclusive else is_ref.cast("int")
    return days.select(
        "day",
        "ref_year",
        F.when(is_ref, number).alias("idx"),
        (number + skip_own_day).alias("lo"),
        F.count("ref_year").over(everything).alias("dates"),
    )


def _rounds(sessions: DataFrame, days: DataFrame) -> DataFrame:
    """Every round, and the first reference date that sees any of its sessions."""
    return (
        sessions.join(days.select("day", "lo", "dates"), "day")
        .groupBy(*ROUND)
        .agg(F.min("lo").alias("lo"), F.max("dates").alias("dates"))
    )


def _listed_until(rounds: DataFrame, last: int) -> DataFrame:
    """``rounds`` with ``until``: the last date before the next ``last`` rounds in order have all been held.

    Most rounds have these within their own season. For the others only the first and the last ``last`` rounds of a
    season matter, so the one window over all seasons holds 2 * last rows a season, however many rounds there are.
    """

    def until(order: WindowSpec) -> Column:
        newer = order.rowsBetween(-last, -1)
        passed = F.count(F.lit(1)).over(newer) == last
        return F.when(passed, F.max("lo").over(newer) - 1)

    backwards = Window.partitionBy("year").orderBy(F.desc("roundnumber"))
    forwards = Window.partitionBy("year").orderBy("roundnumber")
    placed = rounds.select(
        "*", until(backwards).alias("in_season"),
        ((F.row_number().over(backwards) <= last) | (F.row_number().over(forwards) <= last)).alias("edge"),
    )
    across = until(Window.orderBy(F.desc("year"), F.desc("roundnumber")))
    edges = placed.where("edge").withColumn("until", F.coalesce("in_season", across, "dates"))
    inner = placed.where("NOT edge").withColumn("until", F.col("in_season"))
    return edges.unionByName(inner).drop("in_season", "edge")


def _seen_rounds(rounds: DataFrame, last: int | None) -> DataFrame:
    """(idx, year, roundnumber, rn): rounds seen at each reference date, newest first, at most ``last``.

    A round surely has ``last`` newer rounds once the next ``last`` rounds in order have all been held, so it
    need not be listed beyond that date. With rounds held in order that leaves exactly ``last`` per date.
    """
    newest_first = [F.desc("year"), F.desc("roundnumber")]
    dated = rounds.withColumn("until", F.col("dates")) if last is None else _listed_until(rounds, last)
    seen = (
        dated.where("lo <= until")
        .select(*ROUND, F.explode(F.sequence("lo", "until")).alias("idx"))
        .withColumn("rn", F.row_number().over(Window.partitionBy("idx").orderBy(*newest_first)).cast("long"))
    )
    return seen if last is None else seen.where(F.col("rn") <= last)


def _season_ends(sessions: DataFrame, days: DataFrame, max_season_gap: int) -> DataFrame:
    seasons = sessions.select("year", F.lit(None).cast("long").alias("idx"))
    held = days.where(F.col("idx").isNotNull()).select(F.col("ref_year").alias("year"), "idx")
    upto = Window.orderBy("year").rangeBetween(Window.unboundedPreceding, max_season_gap)
    return (
        seasons.unionByName(held)
        .where(F.col("year").isNotNull())
        .groupBy("year")
        .agg(F.max("idx").alias("idx"))
        .select("year", F.coalesce(F.max("idx").over(upto), F.lit(0)).alias("season_end"))
    )


def build_calendar(
    results: DataFrame,
    windows: tuple[int, ...] = (),
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> Calendar:
    """Reads three columns of ``results`` once and stores the calendar in the shared folder."""
    sessions = materialize(session_days(results), "session_days")
    return calendar_of(sessions, windows, year_start, year_stop, max_season_gap, inclusive)


def calendar_of(
    sessions: DataFrame,
    windows: tuple[int, ...] = (),
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> Calendar:
    """The calendar of stored sessions, as ``session_days`` gives them."""
    days = _numbered_days(sessions, year_start, year_stop, inclusive)
    index = sessions.join(days.drop("dates"), "day").join(
        _season_ends(sessions, days, max_season_gap), "year", "left"
    )
    if windows:
        seen = _seen_rounds(_rounds(sessions, days), max(windows))
        ends = seen.groupBy(*ROUND).agg(
            *[(F.max(F.when(F.col("rn") <= n, F.col("idx"))) + 1).alias(f"end_{n}") for n in windows]
        )
        same_round = F.col("i.year").eqNullSafe(F.col("e.year")) & F.col("i.roundnumber").eqNullSafe(
            F.col("e.roundnumber")
        )
        index = (
            index.alias("i")
            .join(ends.alias("e"), same_round, "left")
            .select("i.*", *[f"e.end_{n}" for n in windows])
        )
    return Calendar(materialize(index, "calendar"), max_season_gap, tuple(windows))


def ranked_rounds(
    results: DataFrame,
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    last: int | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """(dt_ref, year, roundnumber, rn): the rounds held up to each reference date, newest first.

    Sessions of one round are one round, and a round counts from its first session on.
    """
    sessions = materialize(session_days(results), "session_days")
    days = _numbered_days(sessions, year_start, year_stop, inclusive)
    dates = days.where(F.col("idx").isNotNull()).select("idx", F.col("day").alias("dt_ref"))
    seen = _seen_rounds(_rounds(sessions, days), last)
    return seen.join(dates, "idx").select("dt_ref", *ROUND, "rn")


def last_rounds(
    results: DataFrame, n: int, year_start: int | None = FIRST_SEASON, year_stop: int | None = LAST_SEASON, inclusive: bool = True
) -> DataFrame:
    return ranked_rounds(results, year_start, year_stop, n, inclusive).drop("rn")
