from __future__ import annotations

import os
import time

import pytest

from seasonstats.operators import model as forest
from seasonstats.plans.lake import Lake
from seasonstats.sources import results as S
from seasonstats.sources.shared import new_folder
from seasonstats.streaming import ingest as I
from tests.conftest import row, rows_of


@pytest.fixture
def folders(spark):
    root = new_folder(spark, "stream").removeprefix("file:")
    return [f"{root}/{name}" for name in ("source", "target", "checkpoint", "archive")]


def drop(df, source):
    df.coalesce(1).write.mode("append").parquet(source)


def files(folder):
    return sorted(f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_each_file_arrives_once(spark, table, folders):
    source, target, checkpoint, _ = folders
    first, second = table([row("2020-01-01", "a")]), table([row("2020-02-01", "a", round_=2)])
    drop(first, source)
    (open(f"{source}/notes.txt", "w")).close()  # other files are not read
    I.ingest(spark, source, target, checkpoint)
    assert S.read_results(spark, target).count() == 1
    I.ingest(spark, source, target, checkpoint)
    assert S.read_results(spark, target).count() == 1
    drop(second, source)
    I.ingest(spark, source, target, checkpoint)
    assert rows_of(S.read_results(spark, target)) == rows_of(first.unionByName(second))


def test_a_session_landed_again_arrives_and_replaces(spark, table, folders):
    source, target, checkpoint, _ = folders
    S.land(table([row("2020-01-01", "a"), row("2020-01-01", "b")]), source)
    I.ingest(spark, source, target, checkpoint)
    time.sleep(1.1)
    S.land(table([row("2020-01-01", "a", points=7.0)]), source)
    I.ingest(spark, source, target, checkpoint)
    stored = S.read_results(spark, target, I.LANDED)
    assert stored.count() == 3
    assert [(r["driverid"], r["points"]) for r in S.latest_by_key(stored).collect()] == [("a", 7.0)]


def test_taken_files_are_archived(spark, table, folders):
    source, target, checkpoint, archive = folders
    for month in (1, 2, 3):
        drop(table([row(f"2020-0{month}-01", "a", round_=month)]), source)
        I.ingest(spark, source, target, checkpoint, clean="archive", archive=archive, max_files=1)
    assert len(files(archive)) >= 1
    assert S.read_results(spark, target).count() == 3


def test_lake_from_files_to_scores(spark, table, folders):
    source, target, checkpoint, _ = folders
    rows = [
        row(f"{year}-{month:02}-01", driver, round_=month, pos=float(place), grid=float(place), points=9.0 - place)
        for year in range(2000, 2006)
        for month in range(1, 9)
        for place, driver in enumerate("abcd" if year % 2 else "bacd", start=1)
    ]
    lake = Lake(spark, f"{target}/lake")
    S.land(table(rows), source)
    base = lake.refresh(source, start="2000-01-01", stop="2006-01-01")
    assert len(base.columns) == 175
    assert base.count() == 6 * 8 * 4
    assert {(r["year"], r["driverid"]) for r in lake.read("champions").collect()} == {
        (year, "a" if year % 2 else "b") for year in range(2000, 2006)
    }
    assert lake.complete_results().count() == len(rows)
    assert lake.refresh_window(2).count() == base.count()
    lake.train(oot_year=2005, trees=5, min_leaf=1, max_depth=4)
    lake.train(oot_year=2005, trees=5, min_leaf=1, max_depth=4)
    assert {r["split"] for r in lake.read("metrics").collect()} == {"train", "test", "oot"}
    assert lake.read("feature_importances").count() == 172
    assert lake.read("model_input_example").count() == 5
    scores = lake.score(base)
    assert scores.count() == base.count()
    assert all(0.0 <= r["proba"] <= 1.0 for r in scores.collect())

    model = forest.load_latest(spark, lake.path("models"))
    assert os.path.isdir(lake.path("models") + "/2")
    stream = spark.readStream.schema(base.schema).parquet(lake.path("abt"))
    I.score_stream(model, stream, f"{target}/scores", checkpoint).awaitTermination()
    assert rows_of(spark.read.parquet(f"{target}/scores")) == rows_of(scores)
