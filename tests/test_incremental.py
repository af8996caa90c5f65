"""Versioned tables, current rows from a stream of files, and refreshes from the first change."""

from __future__ import annotations

import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seasonstats.operators.abt import abt
from seasonstats.operators.champions import champions
from seasonstats.operators.features import feature_table, sessions_from_year
from seasonstats.plans.incremental import IncrementalLake
from seasonstats.schema import LANDED, RESULTS
from seasonstats.sources.files import Files
from seasonstats.sources.shared import new_folder
from seasonstats.sources.versions import ConcurrentChange, VersionedTable
from seasonstats.streaming import current as C
from tests.conftest import row, rows_of


@pytest.fixture
def folder(spark):
    return new_folder(spark, "incremental").removeprefix("file:")


def table_of(spark, folder):
    columns = spark.createDataFrame([], "k string, n long, v long").schema
    return VersionedTable(spark, f"{folder}/table", ("k", "n"), columns, {"most": (F.max("v"), "bigint")})


def test_a_file_is_created_once(spark, folder):
    files = Files(spark)
    assert files.names(folder) == [] and files.create(f"{folder}/a/1", "one")
    assert not files.create(f"{folder}/a/1", "two")
    assert files.text(f"{folder}/a/1") == "one" and [n for n in files.names(f"{folder}/a") if not n.startswith(".")] == ["1"]


def test_versions_replace_partitions_and_stay_readable(spark, folder):
    table = table_of(spark, folder)
    rows = lambda *r: spark.createDataFrame(r, "k string, n long, v long")
    assert table.latest() == 0 and table.read().count() == 0
    table.commit(rows(("a/b =%", 1, 1), ("a/b =%", 1, 2), (None, None, 3), ("+1 c", 2, 4)), None, {"s": 1})
    old = table.read()
    table.commit(rows((None, None, 9)), rows((None, None, 0), ("+1 c", 2, 0)).drop("v"), {"t": 5})
    assert rows_of(table.read()) == rows_of(rows(("a/b =%", 1, 1), ("a/b =%", 1, 2), (None, None, 9)))
    assert old.count() == 4 and table.read(1).count() == 4 and table.applied() == {"s": 1, "t": 5}
    assert sorted(r["most"] for r in table.files().collect()) in ([2, 9], [1, 2, 9])
    only = table.read(files=table.files().where("n = 1"))
    assert only.count() == 2 and all("n=1" in f for f in only.inputFiles())
    with pytest.raises(ConcurrentChange):
        table.commit(rows(("x", 1, 1)), None, {}, base=1)
    assert table.read().count() == 3
    table.vacuum(keep=1)
    assert table.read().count() == 3 and Files(spark).names(f"{table.root}/commits") == ["2"]


def test_compaction_keeps_rows_and_bounds_files(spark, folder):
    table = table_of(spark, folder)
    for i in range(6):
        table.commit(spark.createDataFrame([("a", 1, i), ("b", i, i)], "k string, n long, v long"), None, {})
    before, reader = rows_of(table.read()), table.read()
    assert table.compact(4) == 7
    per_key = {(r["k"], r["n"]): r["count"] for r in table.files().groupBy("k", "n").count().collect()}
    assert per_key[("a", 1)] == 1 and len(per_key) == 7
    assert rows_of(table.read()) == before == rows_of(reader)
    assert table.compact(4) is None


def landed(spark, rows, day):
    time = None if day is None else dt.datetime.fromisoformat(day)
    return spark.createDataFrame([(*r, time) for r in rows], LANDED)


def test_upsert_takes_the_newest_landing_once(spark, folder):
    table = C.current_table(spark, f"{folder}/current")
    session = lambda points, driver="a", round_=1: row("2020-01-01", driver, round_=round_, points=points)
    found = lambda: sorted((r["roundnumber"] or 0, r["driverid"], r["points"]) for r in table.read().collect())
    first = landed(spark, [session(1.0), session(2.0, "b"), session(3.0, round_=None)], None)
    assert C.upsert(table, first, "s", 0) and not C.upsert(table, first, "s", 0)
    assert found() == [(0, "a", 3.0), (1, "a", 1.0), (1, "b", 2.0)]
    C.upsert(table, landed(spark, [session(5.0)], "2024-01-02"), "s", 1)
    C.upsert(table, landed(spark, [session(6.0)], "2024-01-01"), "s", 2)  # late
    C.upsert(table, landed(spark, [session(7.0, "b")], "2024-01-02"), "s", 3)  # the other part of the same landing
    assert found() == [(0, "a", 3.0), (1, "a", 5.0), (1, "b", 7.0)]
    both = landed(spark, [session(8.0)], "2024-01-03").unionByName(landed(spark, [session(9.0)], "2024-01-04"))
    C.upsert(table, both, "t", 0)
    assert found() == [(0, "a", 3.0), (1, "a", 9.0)] and table.applied() == {"s": 3, "t": 0}
    C.upsert(table, landed(spark, [], None), "t", 1)
    assert table.read().count() == 2
    days = {r["roundnumber"]: r["days"] for r in table.files().collect()}
    assert days == {None: [dt.date(2020, 1, 1)], 1: [dt.date(2020, 1, 1)]}


def test_files_of_any_time_unit(spark, folder):
    flat, parted = f"{folder}/landing", f"{folder}/parted"
    os.makedirs(flat)
    os.makedirs(f"{parted}/year=2021/mode=Race")
    day = dt.datetime(2020, 1, 1, 14, 0, 0, 123456)

    def write(name, unit, round_, extra=0, landed_at=None, **more):
        instant = int((day - dt.datetime(1970, 1, 1)).total_seconds()) * {"ns": 10**9, "us": 10**6, "ms": 10**3}[unit] + extra
        columns = {"RoundNumber": pa.array([round_], pa.int32()), "Date": pa.array([instant, None][:1], pa.timestamp(unit)),
                   "driverid": pa.array(["x"]), "points": pa.array([1.5]), **more}
        if landed_at:
            columns["landed_at"] = pa.array([landed_at], pa.timestamp("ns", tz="UTC"))
        pq.write_table(pa.table(columns), f"{name}.parquet", version="2.6")

    own = {"Year": pa.array([2020]), "Mode": pa.array(["Race"])}
    write(f"{flat}/a", "ns", 1, 123_456_789, dt.datetime(2024, 5, 1, 2, 3, 4, 5), **own)
    write(f"{flat}/b", "us", 2, 123_456, **own)
    write(f"{flat}/c", "ms", 3, 123, **own)
    write(f"{parted}/year=2021/mode=Race/d", "ns", 4)
    write(f"{parted}/year=2021/mode=Race/e", "us", 5)
    table = C.current_table(spark, f"{folder}/current")
    C.keep_current(spark, flat, table, f"{folder}/checkpoint", max_files=2).awaitTermination()
    C.keep_current(spark, parted, table, f"{folder}/other").awaitTermination()
    found = {r["roundnumber"]: (r["year"], r["mode"], r["date"].replace(tzinfo=None)) for r in table.read().collect()}
    second = dt.datetime(2020, 1, 1, 14)
    assert found == {
        1: (2020, "Race", second + dt.timedelta(microseconds=123_456)), 2: (2020, "Race", second + dt.timedelta(microseconds=123_456)),
        3: (2020, "Race", second + dt.timedelta(microseconds=123_000)), 4: (2021, "Race", second), 5: (2021, "Race", second),
    }
    stamp = table.read().where("roundnumber = 1").select(F.unix_micros("landed_at").alias("t")).first()["t"]
    assert stamp == int(dt.datetime(2024, 5, 1, 2, 3, 4, 5, dt.timezone.utc).timestamp() * 1_000_000 + 0.5)
    before = table.latest()
    C.keep_current(spark, flat, table, f"{folder}/checkpoint").awaitTermination()  # nothing new
    assert table.latest() == before


def test_a_file_that_is_not_parquet_stops_the_stream(spark, folder):
    os.makedirs(f"{folder}/landing")
    with open(f"{folder}/landing/a.parquet", "wb") as out:
        out.write(b"no parquet file at all")
    table = C.current_table(spark, f"{folder}/current")
    with pytest.raises(Exception, match="is no Parquet file"):
        C.keep_current(spark, f"{folder}/landing", table, f"{folder}/checkpoint").awaitTermination()
    assert table.latest() == 0


def season(year, draw):
    return [
        row(f"{year}-{month:02}-{day:02}", driver, round_=month, mode=mode, pos=float(place), points=float(draw.randrange(9)))
        for month in range(1, 9, 2) for day, mode in ((2, "Sprint"), (3, "Race"))
        for place, driver in enumerate(draw.sample("abcdef", 4), start=1)
    ]


@pytest.mark.parametrize("settings", [{}, {"inclusive": False, "max_season_gap": 1, "windows": (2, 5), "how": "left"}])
def test_refresh_from_the_first_change_equals_a_full_one(spark, table, folder, settings):
    draw = random.Random(11)
    sessions = {}
    lake = IncrementalLake(spark, f"{folder}/lake", **{"windows": (None, 2, 5), **settings})
    full = {k: v for k, v in {"windows": lake.windows, **settings}.items()}

    def land(batch, rows):
        fresh = {}
        for r in rows:
            fresh.setdefault((r[0], r[1], r[2]), []).append(r)
        sessions.update(fresh)
        C.upsert(lake.current, landed(spark, rows, f"2024-01-{batch + 1:02}"), "s", batch)

    def check():
        results = table([r for rows in sessions.values() for r in rows])
        wide, best = feature_table(results, **full), champions(results)
        assert rows_of(lake.read("features").select(*wide.columns)) == rows_of(wide)
        assert rows_of(lake.read("champions").select(*best.columns)) == rows_of(best)
        expected = abt(wide, best)
        assert rows_of(lake.read("abt").select(*expected.columns)) == rows_of(expected)

    land(0, [r for y in range(2015, 2020) for r in season(y, draw)] + [row(None, "a", year=2016, round_=9, points=99.0)])
    assert lake.refresh().everything and lake.refresh() is None
    check()
    names = {r["held"]: {f["file"] for f in lake.table("features").files().collect() if f["held"] == r["held"]}
             for r in lake.table("features").files().collect()}
    # A corrected session of 2018, and a round that was missing.
    land(1, [row("2018-05-03", d, round_=5, points=50.0) for d in "cz"] + [row("2018-04-03", "b", round_=4, points=1.0)])
    change = lake.refresh()
    assert (change.seasons, change.years, change.everything) == ([2018], [2018], False)
    check()
    after = lake.table("features").files().collect()
    for held in (2015, 2016, 2017):  # these partitions are the files they were
        assert {f["file"] for f in after if f["held"] == held} == names[held]
    assert not {f["file"] for f in after if f["held"] >= 2018} & set().union(*names.values())
    files = lake.current.files()
    read = lake._sessions_read(files, sessions_from_year(lake.calendar(), 2018))
    assert 0 < read.count() < 0.75 * files.count()
    # A run that fails between the tables is made good by the next one.
    land(2, [row("2019-07-03", "a", round_=7, points=70.0)])
    broken = IncrementalLake(spark, lake.root, **{"windows": (None, 2, 5), **settings})
    object.__setattr__(broken, "_refresh_base", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        broken.refresh()
    assert lake.refresh().years == [2019]
    check()


def test_empty_lake(spark, folder):
    lake = IncrementalLake(spark, f"{folder}/lake")
    assert lake.refresh() is None
    C.upsert(lake.current, spark.createDataFrame([], LANDED), "s", 0)
    lake.refresh()
    assert lake.read("champions").count() == 0 and len(RESULTS.fields) == 13


def test_the_footer_reader_runs_where_the_package_is_missing():
    import subprocess
    import sys

    from pyspark import cloudpickle

    from seasonstats.streaming.current import _nano_columns

    load = "import pickle, sys; sys.exit(0 if callable(pickle.load(sys.stdin.buffer)) else 1)"
    subprocess.run([sys.executable, "-I", "-c", load], input=cloudpickle.dumps(_nano_columns()), cwd="/", check=True)
