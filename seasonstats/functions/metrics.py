"""The 43 statistics of a competitor over any set of result rows.

Each statistic is split into partials that add up (counts, sums, and sum plus count for a mean), kept per
session mode. Result rows are reduced to one partial row per competitor and session before any shuffle
by competitor, so that a competitor with very many rows costs no more than the calendar is long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seasonstats.schema import RACE, SPRINT

# Output names and their conditions on one result row.
SEASONS = "qtd_seasons"
SESSIONS = "qtd_sessions"
SESSIONS_BY_MODE = {"": "qtd_sessions", "_race": "qtd_race", "_sprint": "qtd_sprint"}
COUNTS = {
    "qtde_sessions_finished": "status = 'Finished' OR startswith(status, '+')",
    "qtde_1pos": "position = 1",
    "qtde_podios": "position <= 3",
    "qtde_pos5": "position <= 5",
    "qtde_gridpos5": "gridposition <= 5",
    "qtde_1_gridposition": "gridposition = 1",
    "qtde_pole_win": "gridposition = 1 AND position = 1",
    "qtd_sessions_with_points": "points > 0",
    "qtde_sessions_with_overtake": "position < gridposition",
}
TOTALS = {"qtde_points": "points"}
MEANS = {
    "avg_gridposition": "gridposition",
    "avg_position": "position",
    "avg_overtake": "gridposition - position",
}
SLICES = {"": None, "_race": RACE, "_sprint": SPRINT}

PARTIALS = [SESSIONS, *COUNTS, *TOTALS, *(f"{m}__{part}" for m in MEANS for part in ("sum", "n"))]
SLICED = [f"{p}{s}" for p in PARTIALS for s in SLICES]
DOUBLES = [*TOTALS, *(f"{m}__sum" for m in MEANS)]  # the partials that are not counts


def metric_names() -> list[str]:
    names = [SEASONS, *SESSIONS_BY_MODE.values()]
    names += [f"{m}{s}" for m in (*COUNTS, *TOTALS, *MEANS) for s in SLICES]
    return names


METRICS = metric_names()


def row_partials() -> list[Column]:
    """Aggregates over result rows, one column per entry of ``PARTIALS``."""
    sql = [f"count(1) AS {SESSIONS}"]
    sql += [f"count_if({condition}) AS {name}" for name, condition in COUNTS.items()]
    sql += [f"sum({value}) AS {name}" for name, value in TOTALS.items()]
    for name, value in MEANS.items():
        sql += [f"sum({value}) AS {name}__sum", f"count({value}) AS {name}__n"]
    return [F.expr(text) for text in sql]


def slice_sums(over: str = "") -> list[Column]:
    """Sum every partial for all modes and for each mode; ``over`` may name a SQL window."""
    columns = []
    for partial in PARTIALS:
        for suffix, mode in SLICES.items():
            value = partial if mode is None else f"if(mode = '{mode}', {partial}, NULL)"
            columns.append(F.expr(f"sum({value}) {over} AS {partial}{suffix}"))
    return columns


def finished_metrics() -> list[Column]:
    """The 43 output columns from sliced sums.

    Counts without rows are 0. Points and means without rows are NULL.
    """
    counts = {SEASONS: SEASONS}
    counts |= {alias: f"{SESSIONS}{s}" for s, alias in SESSIONS_BY_MODE.items()}
    counts |= {f"{name}{s}": f"{name}{s}" for name in COUNTS for s in SLICES}
    sql = [f"coalesce({source}, 0L) AS {alias}" for alias, source in counts.items()]
    sql += [f"{name}{s}" for name in TOTALS for s in SLICES]
    sql += [f"try_divide({name}__sum{s}, {name}__n{s}) AS {name}{s}" for name in MEANS for s in SLICES]
    return [F.expr(text) for text in sql]
