"""Champions, base table, sampling, evaluation and model."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_next, with_row_number, with_running_totals
from seasonstats.operators import evaluation as E
from seasonstats.operators import model as forest
from seasonstats.operators import sampling as P
from seasonstats.operators.abt import abt
from seasonstats.operators.champions import champions, season_ranking
from seasonstats.sources.shared import new_folder
from tests.conftest import row


def test_title_tie_goes_to_the_lower_id_and_other_modes_do_not_count(table):
    rows = [
        row("2000-01-01", "b", points=5.0),
        row("2000-01-01", "a", points=5.0),
        row("2000-01-01", "c", points=50.0, mode="Practice"),
        row("2001-01-01", "c", points=None),
        row("2001-01-01", "d", points=0.0),
    ]
    assert [(r["year"], r["driverid"]) for r in champions(table(rows)).orderBy("year").collect()] == [
        (2000, "a"),
        (2001, "d"),
    ]
    ranks = {(r["year"], r["driverid"]): r["rankdriver"] for r in season_ranking(table(rows)).collect()}
    assert ranks == {(2000, "a"): 1, (2000, "b"): 2, (2001, "d"): 1, (2001, "c"): 2}


def features(spark, years=range(2000, 2004), dates=8, entities=40):
    rows = [
        (f"{y}-{m:02}-01", f"e{e}", float((e * 7 + m) % 13) if e % 5 else None, int(e == y % 10))
        for y in years
        for m in range(1, dates + 1)
        for e in range(entities)
    ]
    df = spark.createDataFrame(rows, "d string, driverid string, speed double, flchampion long")
    return df.select(F.to_date("d").alias("dt_ref"), "driverid", "speed", "flchampion")


def test_abt_label_and_half_open_range(spark):
    base = features(spark).drop("flchampion")
    winners = spark.createDataFrame([(2001, "e1", 9.0, 1), (2002, "e2", 9.0, 1)], "year long, driverid string, totalpoints double, rankdriver long")
    found = abt(base, winners, "2001-02-01", "2002-03-01")
    dates = {str(r["dt_ref"]) for r in found.collect()}
    assert min(dates) == "2001-02-01" and max(dates) == "2002-02-01"
    assert {(r["dt_ref"].year, r["driverid"]) for r in found.where("flchampion = 1").collect()} == {(2001, "e1"), (2002, "e2")}
    assert found.columns == [*base.columns, "flchampion"]


def test_training_sets(spark):
    base = features(spark)
    sets = P.training_sets(base, oot_year=2003).collect()
    by = {s: [r for r in sets if r["split"] == s] for s in ("train", "test", "oot")}
    assert {r["year"] for r in by["oot"]} == {2003} and len(by["oot"]) == 8 * 40  # not trimmed
    assert {r["dt_ref"].month for s in ("train", "test") for r in by[s]} == {1, 2, 3}
    keys = {s: {(r["driverid"], r["year"]) for r in by[s]} for s in ("train", "test")}
    assert not keys["train"] & keys["test"]
    assert len(keys["train"]) == round(117 * 0.8) + round(3 * 0.8)
    winners = {(r["driverid"], r["year"]) for r in by["train"] if r["flchampion"] == 1}
    assert len(winners) == 2
    again = P.training_sets(base.repartition(7), oot_year=2003)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, sets))
    rates = {r["split"]: r for r in P.label_rates(P.training_sets(base, oot_year=2003)).collect()}
    assert rates["oot"]["rows"] == 320 and rates["oot"]["label_rate"] == pytest.approx(1 / 40)


def test_null_profile_and_imputation(spark):
    base = features(spark, years=[2000], dates=1)
    assert [(r["feature"], r["nulls"]) for r in E.null_profile(base, ["speed", "flchampion"]).collect()] == [("speed", 8)]
    filled = E.impute(base, ["speed"])
    assert filled.where("speed = -10000").count() == 8 and filled.columns == base.columns
    nan = spark.createDataFrame([(float("nan"),)], "speed double")
    assert E.impute(nan, ["speed"]).first()["speed"] == E.MISSING


def curve(scored):
    """Definition by counting, without dropping any point."""
    p, n = sum(y for _, y in scored), sum(1 - y for _, y in scored)
    points = [(math.inf, 0.0, 0.0)]
    for t in sorted({s for s, _ in scored}, reverse=True):
        points.append((t, sum(1 - y for s, y in scored if s >= t) / n, sum(y for s, y in scored if s >= t) / p))
    return points


@pytest.mark.parametrize("levels", [3, 12, 1000])
def test_roc_and_auc(spark, levels):
    rnd = random.Random(levels)
    scored = [(rnd.randrange(levels) / levels, int(rnd.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame([("x", *r) for r in scored] + [("y", s, 1 - y) for s, y in scored], "split string, s double, y long")
    found = E.roc_points(df, "s", "y", ["split"]).where("split = 'x'")
    points = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in found.collect()), reverse=True)
    full = curve(scored)
    assert set(points) <= set(full)
    assert points[0] == full[0] and points[-1] == full[-1]
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))
    pairs = [(a, b) for a, y in scored for b, z in scored if y == 1 and z == 0]
    expected = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    auc = {r["split"]: r["auc"] for r in E.auc(df, "s", "y", ["split"]).collect()}
    assert auc["x"] == pytest.approx(expected) == pytest.approx(area)
    assert auc["y"] == pytest.approx(1 - expected)


def test_straight_pieces_of_the_curve_are_left_out(spark):
    df = spark.createDataFrame([(float(s), y) for s in range(10) for y in (0, 1)], "s double, y long")
    found = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in E.roc_points(df, "s", "y").collect()), reverse=True)
    assert found == [(math.inf, 0.0, 0.0), (9.0, 0.1, 0.1), (0.0, 1.0, 1.0)]
    assert E.roc_points(df, "s", "y", drop_intermediate=False).count() == 11


def test_a_row_without_score_is_an_error_or_left_out(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0), (None, 1)], "s double, y long")
    with pytest.raises(Exception, match="no score"):
        E.auc(df, "s", "y").collect()
    assert E.auc(df, "s", "y", unscored="skip").first()["auc"] == 1.0


def test_auc_without_positives_is_null(spark):
    assert E.auc(spark.createDataFrame([(1.0, 0)], "s double, y long"), "s", "y").first()["auc"] is None


def test_running_totals_across_blocks(spark):
    values = list(range(500))
    df = spark.createDataFrame([(k, v) for k in ("p", None) for v in values], "k string, v long").repartition(5)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # rows as few as these would become one block
    try:
        found = with_running_totals(df, ["k"], [F.desc("v")], {"sum": F.col("v")})
    finally:
        spark.conf.set(setting, before)
    assert found.select("__block").distinct().count() > 1
    step = with_next(found, ["k"], [F.desc("v")], F.col("v"), "following")
    for r in step.collect():
        assert r["sum_before"] == sum(values[r["v"] + 1 :]) and r["sum_all"] == sum(values)
        assert r["following"] == (r["v"] - 1 if r["v"] else None)
    ranks = with_row_number(df, ["k"], [F.desc("v")], "rank").collect()
    assert len(ranks) == 1000 and all(r["rank"] == 500 - r["v"] and r["rank_all"] == 500 for r in ranks)


def test_model_versions_and_scores(spark):
    base = features(spark).withColumn("pace", F.col("flchampion") * 10 + F.length("driverid"))
    names = P.feature_names(base)
    assert names == ["speed", "pace"]
    model = forest.fit(base, names, trees=3, min_leaf=2, max_depth=3)
    folder = new_folder(spark, "models")
    with pytest.raises(ValueError, match="no model version"):
        forest.load_latest(spark, folder)
    for number in (2, 9, 10):
        model.write().save(f"{folder}/{number}")
    assert forest.save_version(model, spark, folder) == 11
    latest = forest.load_latest(spark, folder)
    assert forest.model_features(latest) == names
    submitted = base.select("pace", "speed", F.concat_ws("|", "driverid", "dt_ref").alias("id"))
    scores = forest.score(latest, submitted, ("id",))
    assert scores.columns == ["id", "proba"] and scores.count() == base.count()
    with pytest.raises(ValueError, match="no rows"):
        forest.score(latest, submitted.where("1 = 0"), ("id",))
    importances = forest.feature_importances(latest, spark).collect()
    assert importances[0]["feature"] == "pace"
    assert sum(r["importance"] for r in importances) == pytest.approx(1.0)
    judged = forest.with_probability(latest, base)
    assert judged.where("prediction <> CAST(proba > 0.5 AS BIGINT)").count() == 0
    assert E.auc(judged, "proba").first()["auc"] > 0.9
