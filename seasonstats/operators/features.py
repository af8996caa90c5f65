"""Statistics per reference date and competitor: career, last N rounds, one-date snapshot, wide table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonstats.functions import metrics as M
from seasonstats.operators.calendar import (
    FIRST_SEASON,
    LAST_SEASON,
    Calendar,
    build_calendar,
)
from seasonstats.schema import MODES
from seasonstats.sources.shared import materialize

DEFAULT_WINDOWS: tuple[int | None, ...] = (None, 10, 20, 40)
CAREER = 2**31 - 1  # the career as a number of last rounds: more than there are
KEY = ["dt_ref", "driverid"]
TASKS_PER_CORE = 4
UNIT = 1024  # sums of multiples of 1 / UNIT are exact in double precision, in any order, as long as they stay small
LARGEST = 2.0**53
ROWS = 8192  # dates, each a wide row, handed over at once


def window_name(last_rounds: int | None) -> str:
    return "life" if last_rounds is None else f"last{last_rounds}"


def _tasks(spark: SparkSession) -> int:
    """Partitions for cells: as many as for any shuffle, but several per core at least. A fixed number, because
    a cell grows into a row per reference date: sized by the shuffled cells, as adaptive coalescing would, the
    tasks would come out far too few, and their aggregations would spill."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _placeable(results: DataFrame) -> DataFrame:
    """Rows that can be in any statistics, with their day, and modes other than race and sprint as one."""
    known = F.when(F.col("mode").isin(*MODES.values()), F.col("mode"))
    return results.withColumns({"day": F.to_date("date"), "mode": known}).where(
        "driverid IS NOT NULL AND year IS NOT NULL AND day IS NOT NULL"
    )


def _numbered_only() -> list[Column]:
    """A row without a round number makes its competitor eligible, but is in no statistics."""
    return [F.when(F.col("numbered"), F.col(p)).alias(p) for p in M.PARTIALS]


def _placed_cells(results: DataFrame, calendar: Calendar) -> DataFrame:
    """One partial row per (competitor, session, mode), placed in the calendar."""
    keys = ["driverid", "year", "roundnumber", "day", "mode"]
    numbered = F.col("roundnumber").isNotNull().alias("numbered")
    cells = _placeable(results).groupBy(*keys).agg(*M.row_partials()).select(*keys, numbered, *M.PARTIALS)
    cells = cells.select(*keys, "numbered", *_numbered_only())
    same_session = (
        (F.col("c.year") == F.col("i.year"))
        & F.col("c.roundnumber").eqNullSafe(F.col("i.roundnumber"))
        & (F.col("c.day") == F.col("i.day"))
    )
    place = ["lo", "season_end", *[f"end_{n}" for n in calendar.windows]]
    return (
        cells.alias("c")
        .join(calendar.index.alias("i"), same_session)
        .select("c.*", *[f"i.{p}" for p in place])
    )


def _cells(results: DataFrame, calendar: Calendar) -> DataFrame:
    """The same hashed by competitor.

    The first shuffle carries rows that every task has already reduced, so a competitor who owns a large
    share of all results arrives as a few partial rows per session. The second shuffle, by competitor alone,
    serves every window and aggregation that follows.
    """
    return _placed_cells(results, calendar).repartition(_tasks(results.sparkSession), "driverid")


def _is_rounded() -> Column:
    """Whether a cell's values are not such that all sums of few of them are exact."""
    fine = [F.coalesce((F.abs(d) < LARGEST / UNIT**2) & (F.rint(F.col(d) * UNIT) == F.col(d) * UNIT), F.lit(True)) for d in M.DOUBLES]
    return ~reduce(Column.__and__, fine)


def _dated_windows(
    cells: DataFrame,
    windows: tuple[int | None, ...],
    calendar: Calendar,
    how: str,
    first: int | None = None,
    named: bool = True,
) -> DataFrame:
    """(dt_ref, driverid, <metric>_<window>) of eligible competitors with a session in all windows or in the widest, at each
    date from number ``first`` on; the metrics alone are the names if not ``named``.
    """
    widest_first = sorted((CAREER if n is None else n for n in windows), reverse=True)
    if CAREER in widest_first and f"end_{CAREER}" not in cells.columns:
        cells = cells.withColumn(f"end_{CAREER}", F.lit(CAREER).cast("long"))
    suffixes = [f"_{window_name(None if n == CAREER else n)}" if named else "" for n in widest_first]
    narrowest = widest_first[-1] if how == "inner" else widest_first[0]
    return _finished(cells, widest_first, suffixes, narrowest, calendar, 1 if first is None else first)


def _finished(
    cells: DataFrame, windows: list[int], suffixes: list[str], narrowest: int, calendar: Calendar, first: int
) -> DataFrame:
    """(dt_ref, driverid, <metric><suffix>): the statistics of all windows at each date, by running sums of what has come less
    what has gone.

    A cell counts for window n from ``lo`` to the date before ``end_<n>``, or never if there is no such date after ``lo``.
    Rows without a session in the window ``narrowest`` are left out. A competitor's newest round is in every window that holds
    any of its rounds, so that latest season and eligibility are the same for all. A task takes the cells competitor by
    competitor, as many as a batch has, and adds them up as arrays; a competitor has no more cells than the calendar. Counts
    are always exact; where a competitor's other sums might be rounded, they are made date by date, without differences.
    Sums stand for an interval of dates: a row comes with the list of those at which its competitor is eligible, so that Spark
    takes each wide row once for every date, and need not join it with the calendar and cut it again. ``ROWS`` dates are handed
    over at once; the list of a longer interval comes in parts.
    """
    counted = {M.SEASONS: M.SEASONS} | {alias: f"{M.SESSIONS}{s}" for s, alias in M.SESSIONS_BY_MODE.items()}
    counted |= {f"{c}{s}": f"{c}{s}" for c in M.COUNTS for s in M.SLICES}
    means = {f"{m}{s}": (f"{m}__sum{s}", f"{m}__n{s}") for m in M.MEANS for s in M.SLICES}
    totals = {f"{t}{s}": (f"{t}{s}", f"{t}__known{s}") for t in M.TOTALS for s in M.SLICES}
    slices, partials, seasons, sessions = dict(M.SLICES), list(M.PARTIALS), M.SEASONS, M.SESSIONS
    known, metrics, never, unit, largest, most = list(M.TOTALS), list(M.METRICS), CAREER, UNIT, LARGEST, ROWS
    day_of, season_of = calendar.held
    gap = calendar.max_season_gap
    doubles = {f"{d}{s}" for d in M.DOUBLES for s in M.SLICES}
    columns = [(f"{m}{suffix}", "long" if m in counted else "double") for suffix in suffixes for m in metrics]
    schema = "dates array<date>, driverid string, " + ", ".join(f"{name} {kind}" for name, kind in columns)
    labels = ["dates", "driverid", *[name for name, _ in columns]]

    def summed(table):
        import numpy as np
        import pyarrow as pa

        def longs(name, missing=0):
            return table.column(name).fill_null(missing).to_numpy().astype(np.int64)

        names = table.column("driverid").combine_chunks().dictionary_encode()
        who = names.indices.to_numpy().astype(np.int64)
        lo, numbered, year = longs("lo"), table.column("numbered").to_numpy(zero_copy_only=False), longs("year")
        ends = {n: longs(f"end_{n}", -1) for n in windows}
        valid = {n: ends[n] > lo for n in windows}
        place = who << 32
        points = np.unique(np.concatenate([place | lo, *[(place | ends[n])[valid[n]] for n in windows]]))
        of, at = points >> 32, points & 0xFFFFFFFF
        came = np.searchsorted(points, place | lo)
        gone = {n: np.searchsorted(points, (place | ends[n])[valid[n]]) for n in windows}

        def latest(values):
            # The greatest so far of each competitor, whose first change is a cell that comes.
            high = np.full(len(points), -(1 << 31), np.int64)
            np.maximum.at(high, came, values)
            return np.maximum.accumulate((of << 33) + high) - (of << 33)

        last_year = latest(year)
        following = np.append(np.where(of[1:] == of[:-1], at[1:], never), never)
        until = np.minimum(following - 1, latest(longs("season_end")))
        modes = table.column("mode").combine_chunks().fill_null("").to_numpy(zero_copy_only=False)
        values, rounded = {}, np.zeros(len(names.dictionary), bool)
        for name in partials:
            column = table.column(name)
            whole = column.cast(pa.float64()).fill_null(0.0).to_numpy()
            parts = {name: whole}
            if name in doubles:
                units = np.abs(whole) * unit
                rounded[who[np.rint(units) != units]] = True
                rounded |= ~(np.bincount(who, units, len(rounded)) < largest)
            if name in known:
                parts[f"{name}__known"] = column.is_valid().to_numpy().astype(np.float64)
            for part, numbers in parts.items():
                for suffix, mode in slices.items():
                    values[part + suffix] = numbers if mode is None else np.where(modes == mode, numbers, 0.0)

        def standing(starts, stops, numbers):
            net = np.bincount(starts, numbers, len(points)) - np.bincount(stops, numbers, len(points))
            return np.cumsum(net)

        def of_window(n, name):
            numbers = values[name]
            if name not in doubles or not rounded.any():
                return standing(came[valid[n]], gone[n], numbers[valid[n]])
            sums = standing(came[valid[n]], gone[n], np.where(rounded[who], 0.0, numbers)[valid[n]])
            for one in np.flatnonzero(rounded):
                rows = slice(*np.searchsorted(who, [one, one + 1]))
                begin, stop = np.searchsorted(of, [one, one + 1])
                step = max(1, (1 << 20) // (rows.stop - rows.start))
                for i in range(begin, stop, step):
                    days = at[i : min(i + step, stop), None]
                    held = (lo[rows] <= days) & (ends[n][rows] > days)
                    sums[i : i + len(days)] = np.where(held, numbers[rows], 0.0).sum(axis=1)
            return sums

        def seasons_of(n):
            # A season lasts from a cell that comes when no other is held to the last date that one is.
            chosen = np.flatnonzero(valid[n] & numbered)
            chosen = chosen[np.lexsort((lo[chosen], year[chosen], who[chosen]))]
            if not len(chosen):
                return np.zeros(len(points))
            new = np.append(True, (who[chosen][1:] != who[chosen][:-1]) | (year[chosen][1:] != year[chosen][:-1]))
            group = np.cumsum(new) << 32
            held = np.maximum.accumulate(group + ends[n][chosen]) - group
            opens = new | np.append(True, held[:-1] <= lo[chosen][1:])
            closes = np.append(opens[1:], True)
            stops = np.searchsorted(points, (who[chosen] << 32 | held)[closes])
            return standing(came[chosen][opens], stops, np.ones(len(stops)))

        present = {n: of_window(n, sessions) for n in windows}
        begin, until = np.maximum(at, first), np.minimum(until, len(day_of))
        keep = np.flatnonzero((begin <= until) & (present[narrowest] > 0))
        arrays = [names.dictionary.take(pa.array(of[keep]))]
        for n in windows:
            absent = None if n == narrowest else present[n][keep] <= 0
            found = {}
            for alias, source in counted.items():
                whole = seasons_of(n) if source == seasons else of_window(n, source)
                found[alias] = pa.array(whole[keep].astype(np.int64), mask=absent)
            for alias, (source, number) in (totals | means).items():
                number = of_window(n, number)[keep]
                whole = of_window(n, source)[keep]
                if alias in means:
                    whole = whole / np.where(number > 0, number, 1.0)
                found[alias] = pa.array(whole, mask=number <= 0)
            arrays += [found[m] for m in metrics]
        yield from dated(arrays, begin[keep], until[keep], last_year[keep])

    def dated(arrays, begin, until, last_year):
        import numpy as np
        import pyarrow as pa

        days, seasons = np.array(day_of, np.int32), np.array(season_of, np.int64)
        upto = np.cumsum(until - begin + 1)
        for start in range(0, int(upto[-1]) if len(upto) else 0, most):
            place = np.arange(start, min(start + most, upto[-1]))
            row = np.searchsorted(upto, place, "right")
            date = until[row] - (upto[row] - 1 - place) - 1
            fine = seasons[date] - last_year[row] <= gap
            row, date = row[fine], days[date[fine]]
            heads = np.flatnonzero(np.diff(row, prepend=-1))
            if len(heads):
                held = pa.ListArray.from_arrays(pa.array(np.append(heads, len(row)), pa.int32()), pa.array(date, pa.date32()))
                kept = pa.array(row[heads])
                yield pa.RecordBatch.from_arrays([held, *[a.take(kept) for a in arrays]], labels)

    def by_competitor(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column("driverid")[-1]
            start = pc.index(batch.column("driverid"), last).as_py()
            same = bool(held) and held[0].column("driverid")[0] == last
            whole = [] if start == 0 and same else [*held, batch.slice(0, start)]
            if sum(b.num_rows for b in whole):
                yield from summed(pa.Table.from_batches(whole))
            held = [*held, batch] if start == 0 and same else [batch.slice(start)]
        if held:
            yield from summed(pa.Table.from_batches(held))

    needed = ["driverid", "lo", "numbered", "year", "season_end", "mode", *[f"end_{n}" for n in windows], *M.PARTIALS]
    sums = cells.select(*needed).sortWithinPartitions("driverid").mapInArrow(by_competitor, schema)
    return sums.select(F.explode("dates").alias("dt_ref"), *labels[1:])


def _until_next_session(by_time) -> Column:
    """Last reference date at which a cell is the competitor's newest one and the competitor is eligible.

    Cells that share ``lo`` get an empty interval, except the last of them.
    """
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.least(F.lead("lo").over(by_time) - 1, F.max("season_end").over(upto))


def _dates_of(rows: DataFrame, start: str, stop: str) -> DataFrame:
    """Every row at each date of its interval."""
    return rows.where(F.col(start) <= F.col(stop)).withColumn("idx", F.explode(F.sequence(start, stop)))


def window_stats(
    results: DataFrame,
    last_rounds: int | None = None,
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> DataFrame:
    """43 statistics per (dt_ref, driverid), over the career or over the last N rounds of the championship.

    A competitor is listed at a reference date if a session of the season of that date, or of the
    ``max_season_gap`` seasons before it, has been held with the competitor in it.
    """
    windows = () if last_rounds is None else (last_rounds,)
    calendar = build_calendar(results, windows, year_start, year_stop, max_season_gap, inclusive)
    cells = _cells(results, calendar)
    return _dated_windows(cells, (last_rounds,), calendar, "inner", named=False)


def own_window_stats(
    results: DataFrame,
    last_starts: int,
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> DataFrame:
    """43 statistics per (dt_ref, driverid) over the last N rounds that the competitor itself has started in.

    Races and sprints of a round are one start, and a round without a number takes a place among the starts but is in no
    statistics. All steps find the cells hashed by competitor.
    """
    calendar = build_calendar(results, (), year_start, year_stop, max_season_gap, inclusive)
    dates = calendar.dates.count()  # one number
    newest_first = [F.desc("year"), F.desc("roundnumber")]
    by_start = Window.partitionBy("driverid").orderBy(*newest_first)
    of_start = Window.partitionBy("driverid", "year", "roundnumber")
    cells = _cells(results, calendar)
    numbered = cells.select(
        "*", F.dense_rank().over(by_start).cast("long").alias("start"), F.min("lo").over(of_start).alias("first")
    )
    ended = _own_ends(numbered, last_starts, dates)
    return _dated_windows(ended, (last_starts,), calendar, "inner", named=False)


def _own_ends(cells: DataFrame, last: int, dates: int) -> DataFrame:
    """``cells`` with the first date at which ``last`` newer starts than theirs are seen: the date in place ``last`` of those
    that first see a newer start. Beyond the next ``last`` starts only those can be among them that were held before an older
    one, which are none if rounds are held in order.
    """
    by_start = Window.partitionBy("driverid").orderBy("start")
    older = Window.partitionBy("driverid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    in_start = Window.partitionBy("driverid", "start").orderBy("lo")
    once = F.when(F.row_number().over(in_start) == 1, F.col("first"))
    marked = cells.withColumn("once", once).withColumn("early", F.when(F.col("once") < F.max("first").over(older), F.col("once")))
    near = F.collect_list("once").over(by_start.rangeBetween(-last, -1))
    far = F.collect_list("early").over(by_start.rangeBetween(Window.unboundedPreceding, -last - 1))
    placed = F.get(F.sort_array(F.concat(near, far)), F.lit(last - 1))
    return marked.withColumn(f"end_{last}", F.coalesce(placed, F.lit(dates + 1).cast("long")))


def feature_table(
    results: DataFrame,
    windows: tuple[int | None, ...] = DEFAULT_WINDOWS,
    how: str = "inner",
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> DataFrame:
    """All windows side by side, 43 columns per window, from one pass over the results.

    ``how='inner'`` keeps competitors with a session in every window, ``'left'`` all that have one in the
    widest. A window holds all rounds of the narrower ones. The wide rows are never shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    recent = tuple(sorted(n for n in windows if n is not None))
    calendar = build_calendar(results, recent, year_start, year_stop, max_season_gap, inclusive)
    cells = _cells(results, calendar)
    # Competitors whose sums have to be made date by date are apart from the others, as they cost more.
    rounded = cells.withColumn("rounded", F.max(_is_rounded()).over(Window.partitionBy("driverid")))
    apart = [_dated_windows(rounded.where(c).drop("rounded"), windows, calendar, how) for c in ("NOT rounded", "rounded")]
    return apart[0].unionByName(apart[1])


def year_partials(results: DataFrame) -> DataFrame:
    """Partial sums per competitor, season and mode over the sessions held in one calendar year (``held``): what later
    dates need to know of that year for career statistics."""
    keys = ["driverid", "year", "mode", "numbered", "held"]
    rows = _placeable(results).withColumns({"numbered": F.col("roundnumber").isNotNull(), "held": F.year("day")})
    return rows.groupBy(*keys).agg(*M.row_partials()).select(*keys, *_numbered_only())


def features_from_year(
    results: DataFrame, earlier: DataFrame, calendar: Calendar, year: int, windows: tuple[int | None, ...], how: str = "inner"
) -> DataFrame | None:
    """``feature_table`` at the reference dates from the calendar year ``year`` on; None if there are no such dates.

    ``results`` must hold the sessions that ``sessions_from_year`` names; ``earlier`` are the ``year_partials`` of the years
    before. What is held of a competitor's earlier seasons enters the running sums as one cell per season and mode.
    """
    first = first_date_from(calendar, year)
    if first is None:
        return None
    place = _placed_cells(results, calendar)
    columns = ["driverid", "year", "mode", "numbered", "lo", "season_end", *M.PARTIALS]
    seasons = calendar.index.groupBy(F.col("year").alias("of")).agg(F.max("season_end").alias("season_end"))
    before = earlier.join(seasons, F.col("year") == F.col("of")).withColumn("lo", F.lit(first - 1).cast("long"))
    before = before.select(*columns)
    tasks, late, recent = _tasks(results.sparkSession), F.year("day") >= year, F.lit(False)
    if calendar.windows:
        recent = F.coalesce(F.col(f"end_{max(calendar.windows)}") > first, F.lit(False))
    cells = place.where(late | recent).withColumn(f"end_{CAREER}", F.when(late, F.lit(CAREER).cast("long")))
    cells = cells.unionByName(before.withColumn(f"end_{CAREER}", F.lit(CAREER).cast("long")), allowMissingColumns=True)
    return _dated_windows(cells.repartition(tasks, "driverid"), windows, calendar, how, first)


def first_date_from(calendar: Calendar, year: int) -> int | None:
    """Number of the first reference date in a calendar year or later."""
    return calendar.index.where(F.year("day") >= year).agg(F.min("idx")).first()[0]


def sessions_from_year(calendar: Calendar, year: int) -> DataFrame:
    """(year, roundnumber) of the rounds that some statistic from that calendar year on counts one by one."""
    first = first_date_from(calendar, year)
    needed = F.year("day") >= year
    if calendar.windows and first is not None:
        needed = needed | (F.col(f"end_{max(calendar.windows)}") > first)
    return calendar.index.where(needed).select("year", "roundnumber").distinct()


def snapshot_stats(results: DataFrame, as_of: str, max_season_gap: int = 2) -> DataFrame:
    """Career statistics at one date, which need not be a session date. Rows without a round count here.

    Seasons are reduced first and then added up, so that no competitor's rows meet before being reduced and
    the number of seasons needs no separate DISTINCT.
    """
    day = F.lit(as_of).cast("date")
    # As a half-open range on the stored column, the date filter reaches the parquet scan.
    past = results.where(F.col("date") < F.date_add(day, 1).cast("timestamp_ntz"))
    # Stored, so that the results are read once: the newest season comes from the same partial sums.
    per_season = materialize(past.groupBy("driverid", "year", "mode").agg(*M.row_partials()), "season_partials")
    newest = per_season.agg(F.max("year")).scalar()
    named = per_season.where(F.col("driverid").isNotNull())
    seasons = named.groupBy("driverid", "year").agg(*M.slice_sums())
    career = seasons.groupBy("driverid").agg(
        F.count("year").alias(M.SEASONS),
        F.max("year").alias("latest_year"),
        *[F.sum(p).alias(p) for p in M.SLICED],
    )
    return career.where(F.col("latest_year") >= newest - max_season_gap).select(
        day.alias("dt_ref"), "driverid", *M.finished_metrics()
    )


def eligible_entities(
    results: DataFrame,
    year_start: int | None = FIRST_SEASON,
    year_stop: int | None = LAST_SEASON,
    max_season_gap: int = 2,
    inclusive: bool = True,
) -> DataFrame:
    """(dt_ref, driverid) of all competitors seen in the season of the date or up to the gap before it. Rows
    without a competitor appear as one competitor NULL, who is in no statistics."""
    calendar = build_calendar(results, (), year_start, year_stop, max_season_gap, inclusive)
    seen = results.select("driverid", "year", F.to_date("date").alias("day")).dropna(subset=["year", "day"]).distinct()
    place = calendar.index.groupBy("year", "day").agg(F.min("lo").alias("lo"), F.min("season_end").alias("season_end"))
    by_time = Window.partitionBy("driverid").orderBy("lo")
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        seen.join(place, ["year", "day"])
        .repartition(_tasks(results.sparkSession), "driverid")
        .select(
            "driverid",
            "lo",
            _until_next_session(by_time).alias("until"),
            F.max("year").over(upto).alias("latest_year"),
        )
    )
    return (
        _dates_of(spans, "lo", "until")
        .join(F.broadcast(calendar.dates), "idx")
        .where(calendar.eligible(F.col("latest_year")))
        .select(*KEY)
    )


def past_sessions(
    results: DataFrame, year_start: int | None = FIRST_SEASON, year_stop: int | None = LAST_SEASON, inclusive: bool = True
) -> DataFrame:
    """Every result repeated for every reference date from its own on. The output is dates times results:
    use it for small ranges of dates; the statistics do not need it."""
    calendar = build_calendar(results, (), year_start, year_stop, inclusive=inclusive)
    days = calendar.index.groupBy("day").agg(F.min("lo").alias("lo"))
    last = calendar.index.agg(F.max("idx")).scalar()
    dated = results.withColumn("day", F.to_date("date")).join(days, "day").withColumn("last", last)
    return (
        _dates_of(dated, "lo", "last")
        .drop("lo", "last", "day")
        .join(F.broadcast(calendar.dates), "idx")
        .select("dt_ref", "ref_year", *results.columns)
    )


def past_session_counts(
    results: DataFrame, year_start: int | None = FIRST_SEASON, year_stop: int | None = LAST_SEASON
) -> DataFrame:
    """Number of results seen at each reference date: the size of ``past_sessions`` without building it."""
    calendar = build_calendar(results, (), year_start, year_stop)
    per_day = results.groupBy(F.to_date("date").alias("day")).count()
    days = calendar.index.groupBy("day").agg(
        F.min("lo").alias("lo"), F.min("idx").alias("idx"), F.min("ref_year").alias("ref_year")
    )
    upto = Window.orderBy("lo").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # one row per day
    return (
        days.join(per_day, "day")
        .withColumn("results_seen", F.sum("count").over(upto))
        .where(F.col("idx").isNotNull())
        .select(F.col("day").alias("dt_ref"), "ref_year", "results_seen")
    )
