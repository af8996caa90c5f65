"""Statistics against the plain SQL form on random rows, and each rule on rows made for it."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from seasonstats.functions.metrics import METRICS
from seasonstats.operators import calendar as C
from seasonstats.operators import features as X
from seasonstats.plans import oracle as O
from tests.conftest import duck_results, duck_rows, row, rows_of

FIRST, LAST = O.YEARS


def random_rows(seed, ordered=False):
    """Results with missing values everywhere, rounds and seasons held out of order, several sessions a day."""
    rnd = random.Random(seed)
    days = [dt.date(1994, 1, 1) + dt.timedelta(days=rnd.randrange(2900)) for _ in range(45)]
    year_of = {d: d.year + (0 if ordered else rnd.choice([0] * 8 + [-1, 1])) for d in days}
    rows = []
    for _ in range(420):
        day = rnd.choice(days)
        rows.append(
            row(
                None if rnd.random() < 0.03 else day.isoformat(),
                None if rnd.random() < 0.03 else f"d{rnd.randrange(9)}",
                year=year_of[day],
                round_=None if rnd.random() < 0.06 else (day.month if ordered else rnd.randrange(1, 9)),
                mode=rnd.choice(["Race", "Race", "Sprint", "Practice", None]),
                status=rnd.choice(["Finished", "+1 Lap", "Retired", None]),
                pos=rnd.choice([None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 9.0]),
                grid=rnd.choice([None, 0.0, 1.0, 2.0, 5.0, 6.0, 9.0]),
                points=rnd.choice([None, 0.0, 0.5, 1.0, 25.0]),
            )
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("last", [None, 1, 4])
def test_window_stats_equal_plain_form(table, seed, last):
    rows = random_rows(seed, ordered=seed == 3)
    expected, names = duck_rows(
        duck_results(rows), f"WITH {O.DATED}, {O.stats_cte('stats', last)} SELECT * FROM stats"
    )
    stats = X.window_stats(table(rows), last, FIRST, LAST)
    assert sorted(stats.columns) == names
    assert rows_of(stats) == expected


@pytest.mark.parametrize(("seed", "last"), [(1, 1), (2, 4), (3, 2), (6, 30)])
def test_own_window_stats_equal_plain_form(table, seed, last):
    rows = random_rows(seed, ordered=seed == 3)
    expected, _ = duck_rows(duck_results(rows), f"WITH {O.DATED}, {O.own_stats_cte(last)} SELECT * FROM stats")
    assert rows_of(X.own_window_stats(table(rows), last, FIRST, LAST)) == expected
    assert expected


@pytest.mark.parametrize("seed", [4, 5])
def test_rounds_and_eligible_equal_plain_form(table, seed):
    rows = random_rows(seed)
    con = duck_results(rows)
    results = table(rows)
    expected, _ = duck_rows(con, f"WITH {O.DATED} SELECT * FROM ranked")
    assert rows_of(C.ranked_rounds(results, FIRST, LAST)) == expected
    expected, _ = duck_rows(con, f"WITH {O.DATED} SELECT dt_ref, year, roundnumber FROM ranked WHERE rn <= 3")
    assert rows_of(C.last_rounds(results, 3, FIRST, LAST)) == expected
    expected, _ = duck_rows(con, f"WITH {O.DATED} SELECT * FROM eligible")
    assert rows_of(X.eligible_entities(results, FIRST, LAST)) == expected
    columns = "dt_ref, ref_year, driverid, year, roundnumber, date"
    past = "past AS (SELECT * FROM dim_dates JOIN results ON CAST(date AS DATE) <= dt_ref)"
    expected, _ = duck_rows(con, f"WITH {O.DATED}, {past} SELECT {columns} FROM past")
    assert rows_of(X.past_sessions(results, FIRST, LAST).select(*columns.split(", "))) == expected
    expected, _ = duck_rows(
        con, f"WITH {O.DATED}, {past} SELECT dt_ref, ref_year, count(*) AS results_seen FROM past GROUP BY ALL"
    )
    assert rows_of(X.past_session_counts(results, FIRST, LAST)) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_feature_table_is_the_windows_side_by_side(table, how):
    results = table(random_rows(6))
    windows = (None, 2, 5)
    wide = {(r["dt_ref"], r["driverid"]): r for r in X.feature_table(results, windows, how, FIRST, LAST).collect()}
    parts = {
        X.window_name(n): {(r["dt_ref"], r["driverid"]): r for r in X.window_stats(results, n, FIRST, LAST).collect()}
        for n in windows
    }
    keys = set.intersection(*map(set, parts.values())) if how == "inner" else set(parts["life"])
    assert set(wide) == keys
    for key, found in wide.items():
        for window, stats in parts.items():
            for metric in METRICS:
                expected = stats[key][metric] if key in stats else None
                assert found[f"{metric}_{window}"] == expected, (key, metric, window)


def test_names():
    assert len(METRICS) == len(set(METRICS)) == 43
    assert METRICS == [m for m in METRICS if m == m.lower()]


def stats_at(df, day, driver="a"):
    found = [r for r in df.collect() if str(r["dt_ref"]) == day and r["driverid"] == driver]
    return found[0] if found else None


def test_last_n_counts_rounds_of_the_championship_not_own_starts(table):
    rows = [row(f"2000-0{m}-01", "b", round_=m) for m in range(1, 7)] + [row("2000-01-01", "a", round_=1)]
    stats = X.window_stats(table(rows), 3)
    assert stats_at(stats, "2000-03-01")["qtd_sessions"] == 1
    assert stats_at(stats, "2000-04-01") is None  # eligible, but absent from the last three rounds


def test_sprint_and_race_are_one_round(table):
    rows = [
        row("2000-01-01", "a", round_=1),
        row("2000-02-01", "a", round_=2, mode="Sprint"),
        row("2000-02-02", "a", round_=2),
    ]
    stats = X.window_stats(table(rows), 1)
    assert stats_at(stats, "2000-02-01")["qtd_sessions"] == 1  # the race of the round is still to come
    assert (stats_at(stats, "2000-02-02")["qtd_race"], stats_at(stats, "2000-02-02")["qtd_sprint"]) == (1, 1)


def test_own_day_is_included_unless_excluded(table):
    rows = [row("2000-01-01", "a"), row("2000-02-01", "a", round_=2)]
    assert stats_at(X.window_stats(table(rows)), "2000-02-01")["qtd_sessions"] == 2
    assert stats_at(X.window_stats(table(rows), inclusive=False), "2000-02-01")["qtd_sessions"] == 1
    assert stats_at(X.window_stats(table(rows), inclusive=False), "2000-01-01") is None
    assert stats_at(X.window_stats(table(rows), 1, inclusive=False), "2000-02-01")["qtd_sessions"] == 1


def test_gap_of_two_seasons_is_eligible_three_is_not(table):
    rows = [row("2000-01-01", "a")] + [row(f"{y}-05-01", "b") for y in range(2000, 2005)]
    stats = X.window_stats(table(rows))
    assert stats_at(stats, "2002-05-01")["qtd_sessions"] == 1
    assert stats_at(stats, "2003-05-01") is None
    assert stats_at(X.window_stats(table(rows), max_season_gap=3), "2003-05-01") is not None


def test_an_eligible_competitor_brings_the_whole_career(table):
    rows = [row("1992-01-01", "a"), row("2000-01-01", "a")]
    found = stats_at(X.window_stats(table(rows)), "2000-01-01")
    assert (found["qtd_seasons"], found["qtd_sessions"]) == (2, 2)


def test_counts_are_zero_and_points_and_means_null_without_rows(table):
    found = stats_at(X.window_stats(table([row("2000-01-01", "a", points=3.0)])), "2000-01-01")
    assert found["qtd_sprint"] == 0 and found["qtde_podios_sprint"] == 0
    assert found["qtde_points"] == 3.0 and found["qtde_points_sprint"] is None
    assert found["avg_position_sprint"] is None


def test_grid_zero_is_among_the_first_five(table):
    found = stats_at(X.window_stats(table([row("2000-01-01", "a", grid=0.0, pos=4.0)])), "2000-01-01")
    assert (found["qtde_gridpos5"], found["avg_overtake"], found["qtde_sessions_with_overtake"]) == (1, -4.0, 0)


def test_row_without_round_makes_eligible_takes_a_slot_and_is_not_counted(table):
    rows = [
        row("1998-01-01", "a", round_=1),
        row("2001-01-01", "a", round_=None),
        row("2001-02-01", "b", round_=1),
    ]
    assert stats_at(X.window_stats(table(rows)), "2001-02-01")["qtd_sessions"] == 1
    # Newest first the rounds are (2001, 1), (2001, none), (1998, 1).
    assert stats_at(X.window_stats(table(rows), 2), "2001-02-01") is None
    assert stats_at(X.window_stats(table(rows), 3), "2001-02-01")["qtd_sessions"] == 1


def test_snapshot_equals_career_on_a_reference_date(table):
    rows = [r for r in random_rows(8) if r[1] is not None and r[0] is not None]
    results = table(rows)
    dates = [r["dt_ref"] for r in C.reference_dates(results, FIRST, LAST).dropna().collect()]
    day = str(sorted(dates)[len(dates) // 2])
    # The snapshot takes the newest season seen as the season of the date.
    newest = max(r[0] for r in rows if r[3] is not None and str(r[3].date()) <= day)
    ref_year = next(r[0] for r in rows if r[3] is not None and str(r[3].date()) == day)
    snapshot = X.snapshot_stats(results, day, max_season_gap=2 + newest - ref_year)
    career = X.window_stats(results, None, FIRST, LAST).where(f"dt_ref = DATE '{day}'")
    assert rows_of(snapshot) == rows_of(career)


def test_later_rows_do_not_change_earlier_statistics(table):
    rows = random_rows(9)
    cut = "1998-06-30"
    early = [r for r in rows if r[3] is not None and str(r[3].date()) <= cut]
    both = [X.window_stats(table(part), 4, FIRST, LAST).where(f"dt_ref <= DATE '{cut}'") for part in (early, rows)]
    assert rows_of(both[0]) == rows_of(both[1])


def test_counts_grow_with_the_window(table):
    for r in X.feature_table(table(random_rows(10)), (None, 2, 6), "inner", FIRST, LAST).collect():
        for metric in ("qtd_seasons", "qtd_sessions", "qtde_podios", "qtd_sprint"):
            assert r[f"{metric}_last2"] <= r[f"{metric}_last6"] <= r[f"{metric}_life"]
        assert r["qtd_race_life"] + r["qtd_sprint_life"] <= r["qtd_sessions_life"]


def test_conflicting_dates(table):
    rows = [row("2000-01-01", "a"), row("2000-01-01", "b", year=1999), row("2000-02-01", "a")]
    assert [(str(r["dt_ref"]), r["seasons"], r["first_season"]) for r in C.conflicting_dates(table(rows)).collect()] == [
        ("2000-01-01", 2, 1999)
    ]


def test_no_rows(table):
    assert X.window_stats(table([])).collect() == []
    assert X.feature_table(table([])).collect() == []
    assert X.snapshot_stats(table([]), "2000-01-01").collect() == []


def test_cells_are_not_repeated_by_date_before_they_are_added_up(table):
    results = table(random_rows(7))
    for stats in (X.window_stats(results, 4), X.own_window_stats(results, 4), X.feature_table(results, (None, 2, 4))):
        plan = stats._jdf.queryExecution().optimizedPlan().toString()
        steps = re.findall("Generate explode|MapInArrow", plan)  # the last step first
        assert steps and steps == ["Generate explode", "MapInArrow"] * (len(steps) // 2)


def test_sums_that_would_be_rounded_are_added_up_date_by_date(table):
    places = [1e9, 0.1, 0.7, 1e16, 0.1, float("inf"), 0.2]
    rows = [row(f"1995-{m:02d}-15", "a", round_=m, points=p) for m, p in enumerate(places, start=1)]
    rows += [row(f"1995-{m:02d}-15", "b", round_=m, points=0.5) for m in range(1, 8)]
    points = {(str(r["dt_ref"]), r["driverid"]): r["qtde_points"] for r in X.window_stats(table(rows), 1).collect()}
    assert points == {(str(r[3].date()), r[4]): r[8] for r in rows}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_windows_side_by_side_equal_each_window(table, how):
    rows = [(*r[:8], 0.1 if r[4] == "d1" else r[8], *r[9:]) for r in random_rows(8)]
    wide = [r.asDict() for r in X.feature_table(table(rows), (2, 6), how=how).collect()]
    for last in (2, 6):
        own = {(r["dt_ref"], r["driverid"]): r.asDict() for r in X.window_stats(table(rows), last).collect()}
        for r in wide:
            found = own.get((r["dt_ref"], r["driverid"]), {})
            assert [r[f"{m}_last{last}"] for m in METRICS] == pytest.approx([found.get(m) for m in METRICS])
