"""What the plans must and must not contain, and results with one very heavy competitor and session."""

from __future__ import annotations

import random
import re

import pytest

import __spark_entry__ as entry
from seasonstats.operators import features as X
from seasonstats.operators import sampling as P
from seasonstats.operators.abt import abt
from seasonstats.operators.champions import champions
from seasonstats.plans import oracle as O
from seasonstats.plans import registry
from seasonstats.sources import fixtures
from seasonstats.sources import results as S
from seasonstats.sources.shared import materialize
from tests.conftest import SF, duck_results, duck_rows, row, rows_of

FIRST, LAST = O.YEARS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning\((?:[^()]|\([^()]*\))*\)|SinglePartition|rangepartitioning)", text)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - {"stream_ingest", "land_sessions"}))
def test_no_nested_loop_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.fixture(scope="module")
def stored(spark):
    return materialize(fixtures.results(spark, SF), "results")


@pytest.mark.parametrize("last", [None, 10])
def test_window_stats_shuffle_twice(stored, last):
    wider = materialize(stored.selectExpr("*", "'x' AS country"), "wider")
    text = plan(X.window_stats(wider, last, FIRST, LAST))
    big = [e for e in exchanges(text) if "driverid" in e]
    assert len(big) == 2, text  # partial rows by session, then by competitor
    assert "country" not in text  # not read


def test_features_are_not_shuffled_and_results_are_aggregated_once(stored):
    df = X.feature_table(stored, year_start=FIRST, year_stop=LAST)
    for e in exchanges(plan(df)):
        assert "idx" not in e or "driverid" not in e
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_base_table_and_training_rows_do_not_shuffle_features(stored):
    features = materialize(X.window_stats(stored, 10, FIRST, LAST), "features")
    base = abt(features, champions(stored), "1995-01-01", "2002-01-01")
    assert not [e for e in exchanges(plan(base)) if "dt_ref" in e]
    base = materialize(base, "abt")
    sets = plan(P.training_sets(base, 2001))
    wide = [line for line in sets.splitlines() if "Exchange hashpartitioning" in line and "driverid" in line]
    assert not wide
    assert "PushedFilters: [IsNotNull(dt_ref)" in plan(abt(base.drop("flchampion"), champions(stored), "1995-01-01", "2002-01-01"))


def test_champions_are_limited_before_the_shuffle(stored):
    assert plan(champions(stored)).count("WindowGroupLimit") == 2


def test_season_filter_reaches_the_scan(stored):
    text = plan(S.season_filter(stored, years=[1996, 1997], modes=["R"]))
    assert "EqualTo(mode,Race)" in text and "In(year, [1996,1997])" in text


def test_heavy_competitor_and_session(table):
    rnd = random.Random(5)
    rows = [
        row(f"{y}-{m:02}-01", f"d{d}", round_=m, pos=float(rnd.randrange(1, 9)), points=float(rnd.randrange(9)))
        for y in range(1995, 1999)
        for m in range(1, 7)
        for d in range(6)
    ]
    rows += [row("1996-03-01", "d0", round_=3, pos=2.0, points=1.0)] * 700  # most rows of all
    con, results = duck_results(rows), table(rows)
    for last in (None, 4):
        expected, _ = duck_rows(con, f"WITH {O.DATED}, {O.stats_cte('stats', last)} SELECT * FROM stats")
        assert rows_of(X.window_stats(results, last, FIRST, LAST)) == expected


@pytest.mark.parametrize("name", ["oot_rows", "model_input_example"])
def test_wide_rows_that_are_read_once_are_not_stored(spark, monkeypatch, name):
    stored = []
    monkeypatch.setattr(registry, "materialize", lambda df, table, keep=registry.materialize: stored.append(table) or keep(df, table))
    registry.QUERIES[name](spark, SF)
    assert "abt" not in stored


def test_wide_rows_are_not_joined_with_their_dates(stored):
    text = plan(X.feature_table(stored, year_start=FIRST, year_stop=LAST))
    assert text.count("MapInArrow") == 2 and "Join" not in text[: text.rindex("MapInArrow")].split("MapInArrow")[0], text


def test_champions_are_compared_and_not_joined(spark, stored):
    features = spark.sql("""SELECT * FROM VALUES (DATE'1999-03-01', 'a', 1), (DATE'1998-03-01', 'a', 2), (DATE'1999-03-01', NULL, 3),
        (DATE'1999-03-01', 'b', 4), (NULL, 'b', 5) AS rows(dt_ref, driverid, x)""")
    best = spark.sql("""SELECT * FROM VALUES (1999L, 'a', 1L), (1998L, 'b', 1L), (1998L, 'a', 2L), (1999L, NULL, 1L), (NULL, 'b', 1L)
        AS rows(year, driverid, rankdriver)""")
    found = abt(features, best)
    assert "Join" not in plan(found)
    assert {r["x"]: r["flchampion"] for r in found.collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    assert [r["flchampion"] for r in abt(features, best.limit(0), "1999-01-01").collect()] == [0, 0, 0]


def test_results_are_added_up_by_hash(spark):
    assert "SortAggregate" not in plan(fixtures.results(spark, SF))


def test_intervals_of_many_dates_are_handed_over_in_parts(stored, monkeypatch):
    whole = rows_of(X.feature_table(stored, year_start=FIRST, year_stop=LAST))
    monkeypatch.setattr(X, "ROWS", 3)
    assert rows_of(X.feature_table(stored, year_start=FIRST, year_stop=LAST)) == whole
