"""Exact trees against a plain recursive version, selection by digits, model versions and streams that follow them."""

from __future__ import annotations

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from seasonstats.functions import selection
from seasonstats.operators import model as forest
from seasonstats.operators import sampling as P
from seasonstats.operators import tree as T
from seasonstats.sources.files import Files
from seasonstats.sources.shared import materialize, new_folder
from seasonstats.streaming.ingest import score_following
from tests.conftest import rows_of
from tests.test_plans import plan


def mixed(n, p):
    return 2.0 * p * (n - p) / n if n else 0.0


def plain_tree(rows, features, depth, least, node=1):
    """{node: (feature, threshold, rows, positives, decrease)}"""
    n, p = len(rows), sum(r[-1] for r in rows)
    best = None
    if depth:
        for place in range(len(features)):
            values = sorted({r[place] for r in rows})
            for low, high in zip(values, values[1:], strict=False):
                left = [r for r in rows if r[place] <= low]
                right = [r for r in rows if r[place] > low]
                if min(len(left), len(right)) >= least:
                    left_over = mixed(len(left), sum(r[-1] for r in left)) + mixed(len(right), sum(r[-1] for r in right))
                    if best is None or (left_over, place, low) < best[:3]:
                        best = (left_over, place, low, (low + high) / 2, left, right)
    if best is None or mixed(n, p) - best[0] <= 0:
        return {node: (None, None, n, p, None)}
    found = {node: (features[best[1]], best[3], n, p, mixed(n, p) - best[0])}
    found |= plain_tree(best[4], features, depth - 1, least, 2 * node)
    return found | plain_tree(best[5], features, depth - 1, least, 2 * node + 1)


def labelled(n, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.randrange(6), draw.random(), draw.choice([None, float("nan"), 1.0, 2.5])
        rows.append((a, b, c, int(draw.random() < (0.8 if (a > 3) == (b > 0.4) else 0.1))))
    return rows


@pytest.mark.parametrize(("n", "depth", "least"), [(300, 3, 1), (300, 4, 25), (40, 2, 30), (1, 3, 1)])
def test_trees_equal_the_plain_form(spark, n, depth, least):
    rows, names = labelled(n, n + depth), ["a", "b", "c"]
    df = spark.createDataFrame(rows, "a int, b double, c double, flchampion int")
    tree = T.grow_tree(df, names, depth, least)
    full = [(float(a), b, -10000.0 if c is None or c != c else c, y) for a, b, c, y in rows]
    expected = plain_tree(full, names, depth, least)
    found = {r["node"]: (r["feature"], r["threshold"], r["rows"], r["positives"], r["decrease"]) for r in tree.collect()}
    assert found == expected

    def leaf(row):
        node = 1
        while expected[node][0] is not None:
            node = 2 * node + (row[names.index(expected[node][0])] > expected[node][1])
        return expected[node][3] / expected[node][2]

    numbered = materialize(df.coalesce(1).withColumn("id", F.monotonically_increasing_id()), "rows")
    scored = {r["id"]: r["proba"] for r in T.score_tree(tree, numbered, ("id",)).collect()}
    by_id = {r["id"]: (float(r["a"]), r["b"], -10000.0 if r["c"] is None or r["c"] != r["c"] else r["c"]) for r in numbered.collect()}
    assert scored == {i: leaf(r) for i, r in by_id.items()}
    shares = {r["feature"]: r["importance"] for r in T.tree_importances(tree, names).collect()}
    whole = sum(sorted(d for *_, d in expected.values() if d))
    for name in names:
        own = sum(sorted(d for f, *_, d in expected.values() if f == name))
        assert shares[name] == pytest.approx(own / whole if whole else 0.0, abs=1e-12)


def test_trees_without_rows_or_labels(spark):
    kind = "a double, flchampion int"
    assert T.grow_tree(spark.createDataFrame([], kind), ["a"], 2).count() == 0
    assert T.grow_tree(spark.createDataFrame([(1.0, None)], kind), ["a"], 2).count() == 0
    only = T.grow_tree(spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, None)], kind), ["a"], 2).collect()
    assert [(r["node"], r["feature"], r["rows"], r["impurity"]) for r in only] == [(1, None, 2, 0.0)]
    with pytest.raises(ValueError):
        T.grow_tree(spark.createDataFrame([], kind), ["a"], 13)


@pytest.mark.parametrize("share", [0.0, 0.004, 0.5, 1.0])
def test_selection_equals_an_order(spark, share):
    draw = random.Random(4)
    values = [(draw.choice([0, 1, 2, None]), draw.choice(["", "a", "ab0", f"{draw.randrange(9)}", "%08x" % draw.getrandbits(32)])) for _ in range(900)]
    values += [(7, "same")] * 20 + [(8, None)]
    df = spark.createDataFrame(values, "k int, v string").repartition(5)
    found = {r["k"]: r["v"] for r in selection.kth_smallest(df, "k", "v", lambda n: F.ceil(n * share)).collect()}
    expected = {}
    for key in {k for k, v in values if k is not None and v is not None}:
        ordered = sorted(v for k, v in values if k == key and v is not None)
        place = -int(-len(ordered) * share // 1)
        if place:
            expected[key] = ordered[place - 1]
    assert found == expected


def test_selection_orders_nothing_by_range(spark):
    df = spark.createDataFrame([(0, "a")], "k int, v string")
    found = spark.createDataFrame([(0, "", 1)], "k int, begin string, left long")
    text = plan(selection._bins(df, "k", "v", found, 0))
    assert "rangepartitioning" not in text and text.count("HashAggregate") == 2


def test_seasons_after_the_out_of_time_one_are_out_of_time(spark):
    rows = [(f"{y}-0{m}-01", d, float(m), int(d == "a")) for y in (2019, 2020, 2021, 2022) for m in range(1, 9) for d in "abcde"]
    base = spark.createDataFrame(rows, "d string, driverid string, x double, flchampion long").selectExpr(
        "CAST(d AS DATE) AS dt_ref", "driverid", "x", "flchampion"
    )
    base = base.unionByName(spark.createDataFrame([(None, "a", 1.0, 0)], base.schema))
    sets = P.training_sets(base, 2021, drop_last=2).collect()
    assert {(r["year"] >= 2021) == (r["split"] == "oot") for r in sets} == {True}
    assert {r["year"] for r in sets if r["split"] == "oot"} == {2021, 2022}
    assert sum(r["split"] == "oot" for r in sets) == 80 and len(sets) == 80 + 2 * 6 * 5
    assert max(r["dt_ref"].month for r in sets if r["year"] == 2019) == 6


def fitted(spark, feature):
    rows = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, 0, 1), (1, 1, 1)], "low long, many long, flchampion long")
    return forest.fit(rows.withColumn("flchampion", F.col(feature)), [feature], trees=1, min_leaf=1, max_depth=1, bootstrap=False)


def test_versions_of_two_savers_and_a_failed_one(spark):
    folder, model = new_folder(spark, "models"), fitted(spark, "low")
    found = []
    savers = [threading.Thread(target=lambda: found.append(forest.save_version(model, spark, folder))) for _ in range(2)]
    for s in savers:
        s.start()
    for s in savers:
        s.join()
    assert sorted(found) == [1, 2] == forest.versions(spark, folder)

    class Broken:
        def write(self):
            return self

        def save(self, path):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        forest.save_version(Broken(), spark, folder)
    assert forest.latest_version(spark, folder) == 2
    assert forest.save_version(model, spark, folder) == 4 and forest.versions(spark, folder) == [1, 2, 4]
    assert Files(spark).exists(f"{folder}/4/metadata")
    with pytest.raises(ValueError, match="no model"):
        forest.load_latest(spark, new_folder(spark, "none"))


def test_stream_at_an_interval_follows_the_newest_model(spark):
    folder = new_folder(spark, "follow")
    source, target, models = (f"{folder}/{n}" for n in ("source", "target", "models"))
    rows = [spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in part], "id long, low long, many long") for part in ((0, 1), (2, 3))]
    forest.save_version(fitted(spark, "low"), spark, models)
    rows[0].write.parquet(source)
    stream = spark.readStream.schema(rows[0].schema).parquet(source)
    query = score_following(spark, stream, models, target, f"{folder}/checkpoint", ("id",), every="1 second")

    def wait(n):
        end = time.time() + 90
        while time.time() < end:
            if Files(spark).names(target) and spark.read.schema("id long, proba double, version int").parquet(target).count() == n:
                return
            time.sleep(0.5)
        raise AssertionError("the stream did not score its rows")

    try:
        wait(2)
        forest.save_version(fitted(spark, "many"), spark, models)
        rows[1].write.mode("append").parquet(source)
        wait(4)
    finally:
        query.stop()
    found = rows_of(spark.read.parquet(target).select("id", "proba", "version"))
    assert found == [(0, 0.0, 1), (1, 1.0, 1), (2, 1.0, 2), (3, 0.0, 2)]
