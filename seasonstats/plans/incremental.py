"""The flow from landed files to the base table, of which each run does only what the new files call for.

Landed files change current rows session by session. A run compares the files of the current rows with those that the
last run has seen. The earliest day of the sessions that came or changed is where the statistics start to differ:
nothing before it has seen them. From its calendar year on feature rows are made again, from the sessions that their
windows still hold and from sums over the earlier years; champions are made again for the seasons of these sessions,
and base rows where features or champions are new. All else stays in the files it lies in.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstats.operators.abt import abt
from seasonstats.operators.calendar import Calendar, calendar_of
from seasonstats.operators.champions import champions
from seasonstats.operators.features import DEFAULT_WINDOWS, features_from_year, sessions_from_year, year_partials
from seasonstats.schema import SESSION_KEY
from seasonstats.sources.shared import materialize
from seasonstats.sources.versions import VersionedTable, same
from seasonstats.streaming.current import current_table, keep_current


@dataclass(frozen=True)
class Change:
    """What a run has to do: the seasons and calendar years of the changed sessions, and the first of these years."""

    seasons: list[int | None]
    years: list[int]
    everything: bool

    @property
    def first_year(self) -> int | None:
        return min(self.years, default=None)


def _among(column: Column, values: list) -> Column:
    known = column.isin([v for v in values if v is not None])
    return F.coalesce(known, F.lit(False)) | column.isNull() if None in values else known


@dataclass(frozen=True)
class IncrementalLake:
    spark: SparkSession
    root: str
    windows: tuple[int | None, ...] = DEFAULT_WINDOWS
    how: str = "inner"
    year_start: int | None = None
    year_stop: int | None = None
    max_season_gap: int = 2
    inclusive: bool = True
    start: str | None = None
    stop: str | None = None

    @property
    def current(self) -> VersionedTable:
        return current_table(self.spark, f"{self.root}/current")

    def table(self, name: str) -> VersionedTable:
        """``year_sums``, ``features`` and ``abt`` lie by calendar year (``held``), ``champions`` by season."""
        return VersionedTable(self.spark, f"{self.root}/{name}", ("year",) if name == "champions" else ("held",))

    def ingest(self, source: str, **options) -> None:
        """Take the files that have come to ``source`` since the last time."""
        keep_current(self.spark, source, self.current, f"{self.root}/_checkpoints/current", **options).awaitTermination()

    def _settings(self) -> str:
        return json.dumps([self.windows, self.how, self.year_start, self.year_stop, self.max_season_gap, self.inclusive,
                           self.start, self.stop])

    def _change(self, now: int) -> Change | None:
        """What has changed in the current rows since all tables were made; None if nothing has."""
        seen = []
        for name in ("year_sums", "champions", "features", "abt"):
            applied = self.table(name).applied()
            seen.append(applied.get("current", 0) if applied.get("settings") == self._settings() else 0)
        if min(seen) == now:
            return None
        changed = materialize(self.current.changed(min(seen), now).select("year", "days"), "changed")
        # A row per season, and one per calendar year.
        seasons = [r["year"] for r in changed.select("year").distinct().collect()]
        days = changed.select(F.explode("days").alias("day"))
        return Change(seasons, sorted(r[0] for r in days.select(F.year("day")).distinct().collect()), min(seen) == 0)

    def calendar(self, version: int | None = None) -> Calendar:
        """From the list of files, which knows the days of every session; no rows are read."""
        days = self.current.files(version).select("year", "roundnumber", F.explode("days").alias("day"))
        stored = materialize(days.where("day IS NOT NULL").distinct(), "session_days")
        recent = tuple(sorted(n for n in self.windows if n is not None))
        return calendar_of(stored, recent, self.year_start, self.year_stop, self.max_season_gap, self.inclusive)

    def _replace(self, name: str, rows: DataFrame | None, replaced: Column, change: Change, now: int) -> None:
        table = self.table(name)
        base = table.latest()
        keys = None
        if base:
            listed = table.files(base)
            keys = (listed if change.everything else listed.where(replaced)).select(*table.keys)
        elif rows is None:
            return
        table.commit(rows, keys, {"current": now, "settings": self._settings()}, base)

    def _sessions_read(self, files: DataFrame, rounds: DataFrame) -> DataFrame:
        key = SESSION_KEY[:2]
        return files.alias("f").join(rounds.alias("r"), same("f", "r", key), "left_semi")

    def refresh(self) -> Change | None:
        """Bring all tables up to the current rows. A run that fails is made good by the next one."""
        now = self.current.latest()
        change = self._change(now)
        if change is None:
            return None
        files = self.current.files(now)
        held_in = F.exists("days", lambda day: F.year(day).isin(change.years))
        sums = year_partials(self.current.read(files=files.where(held_in)))
        self._replace("year_sums", sums.where(F.col("held").isin(change.years)), F.col("held").isin(change.years), change, now)
        of_season = _among(F.col("year"), change.seasons)
        best = champions(self.current.read(files=files.where(of_season)))
        self._replace("champions", best, of_season, change, now)
        if change.first_year is None:
            late = F.lit(False)
            self._replace("features", None, late, change, now)
        else:
            late = F.col("held") >= change.first_year
            self._replace("features", self._features(now, files, change.first_year), late, change, now)
        self._refresh_base(late | _among(F.col("held"), change.seasons), change, now)
        return change

    def _features(self, now: int, files: DataFrame, year: int) -> DataFrame | None:
        calendar = self.calendar(now)
        rows = self.current.read(files=self._sessions_read(files, sessions_from_year(calendar, year)))
        earlier = self.table("year_sums")
        sums = earlier.read(files=earlier.files().where(F.col("held") < year))
        found = features_from_year(rows, sums, calendar, year, self.windows, self.how)
        return None if found is None else found.withColumn("held", F.year("dt_ref"))

    def _refresh_base(self, touched: Column, change: Change, now: int) -> None:
        features = self.table("features")
        if not features.latest():
            return
        listed = features.files()
        rows = features.read(files=listed if change.everything else listed.where(touched))
        base = abt(rows, self.table("champions").read(), self.start, self.stop)
        self._replace("abt", base, touched, change, now)

    def read(self, name: str) -> DataFrame:
        rows = self.table(name).read()
        return rows.drop("held") if "held" in rows.columns else rows
