"""The registered queries as plain SQL for DuckDB.

Written the direct way (joins on ``date <= dt_ref``, DISTINCT, row numbers), so that it checks the interval
form the Spark operators use.
"""

from __future__ import annotations

YEARS = (1995, 2001)
SNAPSHOT_DATE = "1999-06-14"

RESULTS = """
results AS MATERIALIZED (
  SELECT CAST(y AS BIGINT) AS year, CAST(m AS BIGINT) AS roundnumber, mode,
         CAST(make_date(y, m, CASE WHEN mode = 'Race' THEN 15 ELSE 14 END) AS TIMESTAMP) AS date,
         l_suppkey || '-' || ((y - 1990 + l_suppkey % 4) // (1 + l_suppkey % 5)) AS driverid,
         CASE flag WHEN 'A' THEN 'Finished' WHEN 'N' THEN '+1 Lap' ELSE 'Retired' END AS status,
         CASE WHEN flag = 'R' AND l_suppkey % 2 = 0 THEN NULL ELSE place END AS position,
         CAST((quantity + l_suppkey) % 23 AS DOUBLE) AS gridposition,
         CASE WHEN mode = 'Race' AND place <= 10 THEN 11 - place
              WHEN mode = 'Sprint' AND place <= 8 THEN (9 - place) * 0.5 ELSE 0 END AS points
  FROM (
    SELECT l_suppkey, year(l_shipdate) AS y, month(l_shipdate) AS m,
           CASE WHEN l_linestatus = 'O' THEN 'Race' ELSE 'Sprint' END AS mode,
           CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 100 AS BIGINT) % 22 + 1 AS DOUBLE) AS place,
           CAST(sum(l_quantity) AS BIGINT) AS quantity, min(l_returnflag) AS flag
    FROM lineitem
    GROUP BY ALL))"""

SESSIONS = """
sessions AS (
  SELECT r.year, r.roundnumber, r.mode,
         printf('%s ROUND %02d OF %d', upper(r.mode), r.roundnumber, r.year) AS officialeventname,
         printf('Round %02d', r.roundnumber) AS eventname, n_name AS country, r_name AS location
  FROM (SELECT DISTINCT year, roundnumber, mode FROM results) r
  JOIN nation ON n_nationkey = r.roundnumber JOIN region ON r_regionkey = n_regionkey)"""

_COUNTED = [
    ("qtde_sessions_finished", "(status = 'Finished' OR status LIKE '+%')"),
    ("qtde_1pos", "position = 1"),
    ("qtde_podios", "position <= 3"),
    ("qtde_pos5", "position <= 5"),
    ("qtde_gridpos5", "gridposition <= 5"),
    ("qtde_1_gridposition", "gridposition = 1"),
    ("qtde_pole_win", "(gridposition = 1 AND position = 1)"),
    ("qtd_sessions_with_points", "points > 0"),
    ("qtde_sessions_with_overtake", "position < gridposition"),
]
_VALUED = [
    ("qtde_points", "sum(points)"),
    ("avg_gridposition", "avg(gridposition)"),
    ("avg_position", "avg(position)"),
    ("avg_overtake", "avg(gridposition - position)"),
]
_MODES = [("", "TRUE"), ("_race", "mode = 'Race'"), ("_sprint", "mode = 'Sprint'")]


def metric_sql() -> dict[str, str]:
    sql = {"qtd_seasons": "count(DISTINCT year)", "qtd_sessions": "count(*)"}
    for suffix, of_mode in _MODES[1:]:
        sql[f"qtd{suffix}"] = f"count(*) FILTER (WHERE {of_mode})"
    for suffix, of_mode in _MODES:
        for name, condition in _COUNTED:
            sql[name + suffix] = f"count(*) FILTER (WHERE {condition} AND {of_mode})"
        for name, value in _VALUED:
            sql[name + suffix] = f"{value} FILTER (WHERE {of_mode})"
    return sql


METRICS = metric_sql()
METRIC_LIST = ",\n       ".join(f"{value} AS {name}" for name, value in METRICS.items())

# From the definitions: a competitor counts at a date if some session of the date's season or the two before has been
# held by then; a round's number is one more than the newer rounds held by then, a round without a number being
# the oldest of its season.
DATED = f"""
dim_dates AS MATERIALIZED (
  SELECT CAST(date AS DATE) AS dt_ref, min(year) AS ref_year FROM results
  WHERE year >= {YEARS[0]} AND year <= {YEARS[1]} GROUP BY 1),
rounds AS MATERIALIZED (
  SELECT year, roundnumber, min(CAST(date AS DATE)) AS first_day FROM results GROUP BY year, roundnumber),
ranked AS MATERIALIZED (
  SELECT dt_ref, own.year, own.roundnumber,
         1 + (SELECT count(*) FROM rounds newer WHERE newer.first_day <= dt_ref
              AND (newer.year > own.year OR newer.year = own.year AND (newer.roundnumber > own.roundnumber
                   OR newer.roundnumber IS NOT NULL AND own.roundnumber IS NULL))) AS rn
  FROM dim_dates, rounds own WHERE own.first_day <= dt_ref),
debuts AS MATERIALIZED (
  SELECT driverid, year, min(CAST(date AS DATE)) AS first_day FROM results GROUP BY driverid, year),
eligible AS MATERIALIZED (
  SELECT dt_ref, driverid FROM dim_dates, (SELECT DISTINCT driverid FROM results) who
  WHERE EXISTS (FROM debuts WHERE debuts.driverid IS NOT DISTINCT FROM who.driverid AND first_day <= dt_ref
                AND year >= ref_year - 2 AND year <= ref_year))"""


def stats_cte(name: str, last: int | None) -> str:
    among = "" if last is None else f"WHERE rn <= {last}"
    return f"""
{name} AS MATERIALIZED (
  SELECT dt_ref, driverid, {METRIC_LIST}
  FROM (FROM ranked {among}) JOIN results USING (year, roundnumber)
  WHERE CAST(date AS DATE) <= dt_ref AND driverid IS NOT NULL
    AND (dt_ref, driverid) IN (SELECT (dt_ref, driverid) FROM eligible)
  GROUP BY ALL)"""


def window_sql(last: int | None) -> str:
    return f"WITH {RESULTS}, {DATED}, {stats_cte('stats', last)} SELECT * FROM stats"


def own_window_sql(last: int) -> str:
    return f"""WITH {RESULTS}, {DATED}, {own_stats_cte(last)} SELECT * FROM stats"""


def own_stats_cte(last: int) -> str:
    """Over the rounds that the competitor itself has started in, the newest first."""
    return f"""
own AS MATERIALIZED (
  SELECT dt_ref, driverid, year, roundnumber FROM dim_dates, (
    SELECT driverid, year, roundnumber, min(CAST(date AS DATE)) AS first_day FROM results
    WHERE driverid IS NOT NULL AND year IS NOT NULL GROUP BY ALL) WHERE first_day <= dt_ref
  QUALIFY row_number() OVER (PARTITION BY dt_ref, driverid ORDER BY year DESC, roundnumber DESC NULLS LAST) <= {last}),
stats AS MATERIALIZED (
  SELECT dt_ref, driverid, {METRIC_LIST} FROM own JOIN results USING (driverid, year, roundnumber)
  WHERE CAST(date AS DATE) <= dt_ref AND (dt_ref, driverid) IN (SELECT (dt_ref, driverid) FROM eligible)
  GROUP BY ALL)"""


WINDOWS = {"life": None, "last10": 10, "last20": 20, "last40": 40}
FEATURES = [f"{metric}_{window}" for window in WINDOWS for metric in METRICS]
_WIDE_LIST = ", ".join(f"{w}.{m} AS {m}_{w}" for w in WINDOWS for m in METRICS)
WIDE = (
    f"{RESULTS}, {DATED}, "
    + ", ".join(stats_cte(name, last) for name, last in WINDOWS.items())
    + f""",
features AS MATERIALIZED (
  SELECT dt_ref, driverid, {_WIDE_LIST}
  FROM life JOIN last10 USING (dt_ref, driverid) JOIN last20 USING (dt_ref, driverid)
  JOIN last40 USING (dt_ref, driverid))"""
)

POINTS = """
season_points AS (
  SELECT year, driverid, sum(points) AS totalpoints FROM results
  WHERE mode IN ('Race', 'Sprint') GROUP BY year, driverid)"""
# A competitor's place is one more than the competitors with more points, or as many and a lower id.
RANKING = f"""{POINTS},
season_ranking AS MATERIALIZED (
  SELECT own.*, 1 + (SELECT count(*) FROM season_points better WHERE better.year = own.year
                     AND (better.totalpoints > own.totalpoints
                          OR better.totalpoints = own.totalpoints AND better.driverid < own.driverid)) AS rankdriver
  FROM season_points own),
champions AS (SELECT * FROM season_ranking WHERE rankdriver = 1)"""

ABT = f"""{WIDE}, {RANKING},
abt AS MATERIALIZED (
  SELECT f.*, CAST(coalesce(c.rankdriver, 0) AS BIGINT) AS flchampion
  FROM features f LEFT JOIN champions c ON c.driverid = f.driverid AND c.year = year(f.dt_ref)
  WHERE f.dt_ref >= DATE '1995-01-01' AND f.dt_ref < DATE '2002-01-01')"""

# The base table cut down to the columns a query reads.
SHORT_ABT = f"""{RESULTS}, {DATED}, {stats_cte('last10', 10)}, {RANKING},
abt AS MATERIALIZED (
  SELECT f.dt_ref, f.driverid, f.avg_gridposition AS avg_gridposition_last10,
         CAST(coalesce(c.rankdriver, 0) AS BIGINT) AS flchampion
  FROM last10 f LEFT JOIN champions c ON c.driverid = f.driverid AND c.year = year(f.dt_ref))"""


# A tree by its definition: per level and node, every split between two neighbouring distinct values of a feature.
TREE_FEATURES = ["avg_gridposition", "qtde_points", "avg_position", "qtde_sessions_with_overtake_race"]
TREE_DEPTH, TREE_LEAF = 3, 20


def _mixed(n: str, p: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 0 ELSE 2.0::DOUBLE * ({p})::DOUBLE * (({n}) - ({p}))::DOUBLE / ({n})::DOUBLE END"


def _tree_level(level: int) -> str:
    return f"""
long{level} AS MATERIALIZED (
  SELECT node, place, value, count(*) AS n, sum(flchampion) AS p FROM (
    SELECT node, flchampion, unnest(range({len(TREE_FEATURES)})) AS place,
           unnest([{", ".join(TREE_FEATURES)}]) AS value FROM at{level})
  GROUP BY ALL),
split{level} AS MATERIALIZED (
  SELECT node, place, value, (value + next) / 2 AS threshold, an, ap,
         {_mixed("ln", "lp")} + {_mixed("an - ln", "ap - lp")} AS left_over
  FROM (SELECT node, place, value, lead(value) OVER along AS next, sum(n) OVER upto AS ln, sum(p) OVER upto AS lp,
               sum(n) OVER (PARTITION BY node, place) AS an, sum(p) OVER (PARTITION BY node, place) AS ap
        FROM long{level} WINDOW along AS (PARTITION BY node, place ORDER BY value),
          upto AS (PARTITION BY node, place ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WHERE next IS NOT NULL AND ln >= {TREE_LEAF} AND an - ln >= {TREE_LEAF}),
best{level} AS MATERIALIZED (
  SELECT node, place, threshold, {_mixed("an", "ap")} - left_over AS decrease FROM split{level}
  WHERE {_mixed("an", "ap")} - left_over > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY left_over, place, value) = 1),
at{level + 1} AS MATERIALIZED (
  SELECT a.* REPLACE (2 * a.node + CASE WHEN [{", ".join(TREE_FEATURES)}][b.place + 1] <= b.threshold THEN 0 ELSE 1 END AS node)
  FROM at{level} a JOIN best{level} b ON b.node = a.node)"""


TREE_ABT = f"""{RESULTS}, {DATED}, {stats_cte('last10', 10)}, {RANKING},
abt AS MATERIALIZED (
  SELECT f.dt_ref, f.driverid, {", ".join(f"coalesce(f.{m}::DOUBLE, -10000) AS {m}" for m in TREE_FEATURES)},
         CAST(coalesce(c.rankdriver, 0) AS BIGINT) AS flchampion
  FROM last10 f LEFT JOIN champions c ON c.driverid = f.driverid AND c.year = year(f.dt_ref)
  WHERE f.dt_ref >= DATE '1995-01-01' AND f.dt_ref < DATE '2002-01-01')"""
_PASSED = " UNION ALL ".join(f"SELECT * FROM at{level}" for level in range(TREE_DEPTH + 1))
_SPLITS = " UNION ALL ".join(f"SELECT * FROM best{level}" for level in range(TREE_DEPTH))
TREE = f"""{TREE_ABT}, at0 AS MATERIALIZED (SELECT *, 1::BIGINT AS node FROM abt),
{", ".join(_tree_level(level) for level in range(TREE_DEPTH))},
passed AS MATERIALIZED ({_PASSED}), splits AS MATERIALIZED ({_SPLITS}),
tree AS MATERIALIZED (
  SELECT node, [{", ".join(f"'{m}'" for m in TREE_FEATURES)}][place + 1] AS feature, threshold, rows, positives,
         {_mixed("rows", "positives")} / rows::DOUBLE AS impurity, decrease
  FROM (SELECT node, count(*) AS rows, CAST(sum(flchampion) AS BIGINT) AS positives FROM passed GROUP BY node)
  LEFT JOIN splits USING (node))"""
