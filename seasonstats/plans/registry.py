"""The queries offered to the driver: every operator over whole tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstats.operators import evaluation, sampling, tree
from seasonstats.operators import model as forest
from seasonstats.operators.abt import abt
from seasonstats.operators.calendar import last_rounds, ranked_rounds, reference_dates
from seasonstats.operators.champions import champions, season_points, season_ranking
from seasonstats.operators.features import past_sessions as expanded_sessions
from seasonstats.operators.features import (
    eligible_entities,
    feature_table,
    own_window_stats,
    past_session_counts,
    snapshot_stats,
    window_stats,
)
from seasonstats.plans import oracle as O
from seasonstats.plans.incremental import IncrementalLake
from seasonstats.plans.lake import Lake
from seasonstats.schema import LANDED, RESULTS, SESSION_KEY
from seasonstats.sources import fixtures
from seasonstats.sources import results as S
from seasonstats.sources.shared import materialize, new_folder
from seasonstats.streaming import current
from seasonstats.streaming.ingest import ingest, score_following

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

FIRST, LAST = fixtures.YEARS
ABT_RANGE = ("1995-01-01", "2002-01-01")
RESULT_COLUMNS = ["year", "roundnumber", "mode", "date", "driverid", "status", "position", "gridposition", "points"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.results(spark, sf_dir)


def _stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results as a stored table, as the operators that read them more than once find them."""
    return materialize(fixtures.results(spark, sf_dir), "results")


# Results: scan, selection, landing -----------------------------------------------------------------


@query(f"WITH {O.RESULTS} SELECT * FROM results")
def scan_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir)


@query(f"WITH {O.RESULTS} SELECT * FROM results WHERE year BETWEEN 1996 AND 1998 AND mode = 'Race'")
def season_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.season_filter(_results(spark, sf_dir), start=1996, stop=1998, modes=["R"])


@query(f"WITH {O.RESULTS} SELECT * FROM results WHERE CAST(date AS DATE) <= DATE '{O.SNAPSHOT_DATE}'")
def until_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.until_date(_results(spark, sf_dir), O.SNAPSHOT_DATE)


@query(f"WITH {O.RESULTS}, {O.SESSIONS} SELECT r.*, s.* EXCLUDE (year, roundnumber, mode) "
       "FROM results r JOIN sessions s USING (year, roundnumber, mode)")
def enrich_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.enrich(_results(spark, sf_dir), fixtures.sessions(spark, sf_dir))


@query(f"""WITH {O.RESULTS} SELECT year, roundnumber, mode, count(*) AS rows,
    printf('%d_%02d_%s.parquet', year, roundnumber, left(mode, 1)) AS file FROM results GROUP BY ALL""")
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.landing_manifest(_results(spark, sf_dir))


def _corrections(results: DataFrame) -> DataFrame:
    """A second landing of every third round: a point more for all, and some competitors withdrawn."""
    again = results.where("roundnumber % 3 = 0 AND CAST(substring_index(driverid, '-', 1) AS BIGINT) % 5 <> 0")
    return again.withColumn("points", F.col("points") + 1)


_CORRECTED = """corrected AS (SELECT * REPLACE (points + 1 AS points) FROM results
  WHERE roundnumber % 3 = 0 AND CAST(split_part(driverid, '-', 1) AS BIGINT) % 5 <> 0)"""
_REPLACED = f"""WITH {O.RESULTS}, {_CORRECTED},
  landings AS (SELECT *, 1 AS landing FROM results UNION ALL SELECT *, 2 FROM corrected)
  SELECT * EXCLUDE (landing) FROM landings
  QUALIFY landing = max(landing) OVER (PARTITION BY year, roundnumber, mode)"""


@query(_REPLACED)
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _stored_results(spark, sf_dir)
    day = F.lit("2001-01-01").cast("timestamp")
    landings = first.withColumn("landed_at", day).unionByName(
        _corrections(first).withColumn("landed_at", F.date_add(day, 1).cast("timestamp"))
    )
    return S.latest_by_key(landings).drop("landed_at")


@query(_REPLACED)
def land_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _stored_results(spark, sf_dir)
    folder = new_folder(spark, "landing")
    S.land(first, folder)
    S.land(_corrections(first), folder)
    return S.read_results(spark, folder).select(*RESULT_COLUMNS)


@query(f"WITH {O.RESULTS} SELECT * FROM results")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream")
    landing, target, checkpoint = (f"{folder}/{name}" for name in ("landing", "table", "checkpoint"))
    S.land(_results(spark, sf_dir), landing)
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, landing, target, checkpoint)
    return S.read_results(spark, target, LANDED).select(*RESULT_COLUMNS)


def _as_uri(folder: str) -> str:
    return folder if ":/" in folder else f"file:{folder}"


def _at(day: str) -> Column:
    return F.lit(day).cast("timestamp")


@query(f"""WITH {O.RESULTS} SELECT * REPLACE (CASE WHEN roundnumber % 2 = 0 THEN date + to_microseconds(123456) ELSE date END AS date)
    FROM results""")
def ingest_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of even rounds land as files with times in nanoseconds, the others in microseconds."""
    folder, first = _as_uri(new_folder(spark, "nanos")), _stored_results(spark, sf_dir)
    landing, even = f"{folder}/landing", F.col("roundnumber") % 2 == 0
    first.where(~even).repartition(*SESSION_KEY).write.parquet(landing)
    late = first.where(even).withColumn("date", F.col("date") + F.expr("INTERVAL '0.123456' SECOND"))
    fixtures.land_nanos(late, landing)
    table = current.current_table(spark, f"{folder}/current")
    current.keep_current(spark, landing, table, f"{folder}/checkpoint", max_files=50).awaitTermination()
    return table.read().select(*RESULT_COLUMNS)


@query(_REPLACED)
def current_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings kept as current rows; the second one's batch comes again after it was stored, an older one late."""
    first, folder = _stored_results(spark, sf_dir), new_folder(spark, "upsert")
    table = current.current_table(spark, f"{folder}/current")
    landed = lambda rows, day: S.normalise(rows.withColumn("landed_at", _at(day)), LANDED)
    current.upsert(table, landed(first, "2001-01-01"), "landing", 0)
    for _ in range(2):
        current.upsert(table, landed(_corrections(first), "2001-01-02"), "landing", 1)
    late = first.where("roundnumber % 3 = 0").withColumn("points", F.lit(0.0))
    current.upsert(table, landed(late, "2000-12-31"), "landing", 2)
    return table.read().select(*RESULT_COLUMNS)


@query(f"WITH {O.RESULTS} SELECT *, 1::BIGINT AS files FROM results")
def compact_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that came in four parts each, put together; every row is given with the number of its session's files."""
    first, folder = _stored_results(spark, sf_dir), new_folder(spark, "compact")
    table = current.current_table(spark, f"{folder}/current")
    for part in range(4):
        rows = first.where(F.pmod(F.xxhash64("driverid"), F.lit(4)) == part).withColumn("landed_at", _at("2001-01-01"))
        current.upsert(table, S.normalise(rows, LANDED), "landing", part)
    table.compact(least_files=2)
    held = table.files().groupBy(*SESSION_KEY).agg(F.count(F.lit(1)).alias("files"))
    return table.read().select(*RESULT_COLUMNS).join(held, SESSION_KEY)


@query(f"""WITH {O.RESULTS}, held AS (SELECT * FROM results WHERE NOT (mode = 'Race' AND roundnumber = 5 + year % 4)),
  races AS (SELECT year AS y, roundnumber AS r, row_number() OVER (PARTITION BY year ORDER BY roundnumber) AS n
            FROM (SELECT DISTINCT year, roundnumber FROM held WHERE mode = 'Race' AND roundnumber BETWEEN 1 AND 49))
  SELECT held.* FROM held JOIN races ON y = year AND r = roundnumber WHERE r = n""")
def contiguous_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _stored_results(spark, sf_dir).where("NOT (mode = 'Race' AND roundnumber = 5 + year % 4)")
    return S.contiguous_rounds(held)


@query("SELECT event_id, make_timestamp(CAST((epoch_us(ts) * 1000 + event_id % 1000) // 1000 AS BIGINT)) AS ts "
       "FROM events")
def timestamp_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.read(spark, sf_dir, "events")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    nanos = F.timestamp_diff("MICROSECOND", epoch, F.col("ts")) * 1000 + F.col("event_id") % 1000
    return events.select("event_id", S.micros_from_nanos(nanos).alias("ts"))


@query(f"""WITH {O.RESULTS} SELECT * REPLACE (CASE WHEN gridposition <> 0 THEN gridposition END AS gridposition)
    FROM results""")
def normalise_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns in other letter case, with NaN for a missing grid place."""
    raw = _results(spark, sf_dir).withColumn(
        "gridposition", F.when(F.col("gridposition") != 0, F.col("gridposition")).otherwise(F.lit(float("nan")))
    )
    raw = raw.withColumnsRenamed({c: c.title() for c in raw.columns})
    return S.normalise(raw, RESULTS).select(*RESULT_COLUMNS)


# Calendar and statistics ----------------------------------------------------------------------------


@query(f"WITH {O.RESULTS}, {O.DATED} SELECT * FROM dim_dates")
def reference_dates_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_dates(_results(spark, sf_dir), FIRST, LAST)


@query(f"""WITH {O.RESULTS}, {O.DATED} SELECT dt_ref, ref_year,
    (SELECT count(*) FROM results WHERE CAST(date AS DATE) <= dt_ref) AS results_seen FROM dim_dates""")
def past_session_counts_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return past_session_counts(_stored_results(spark, sf_dir), FIRST, LAST)


@query(f"""WITH {O.RESULTS}, {O.DATED} SELECT dt_ref, driverid, count(*) AS sessions, sum(points) AS points
    FROM dim_dates JOIN results ON CAST(date AS DATE) <= dt_ref WHERE ref_year = {LAST} GROUP BY ALL""")
def past_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expansion itself (all results before a date, so for few dates), over the dates of the last season."""
    seen = expanded_sessions(_stored_results(spark, sf_dir), LAST, LAST)
    return seen.groupBy("dt_ref", "driverid").agg(F.count(F.lit(1)).alias("sessions"), F.sum("points").alias("points"))


@query(f"WITH {O.RESULTS}, {O.DATED} SELECT * FROM eligible")
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible_entities(_stored_results(spark, sf_dir), FIRST, LAST)


@query(f"WITH {O.RESULTS}, {O.DATED} SELECT * FROM ranked")
def rounds_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_rounds(_results(spark, sf_dir), FIRST, LAST)


@query(f"WITH {O.RESULTS}, {O.DATED} SELECT dt_ref, year, roundnumber FROM ranked WHERE rn <= 10")
def last_rounds_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_rounds(_results(spark, sf_dir), 10, FIRST, LAST)


def _window_query(name: str, last: int | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return window_stats(_stored_results(spark, sf_dir), last, FIRST, LAST)

    run.__name__ = f"window_stats_{name}"
    query(O.window_sql(last))(run)


for _name, _last in O.WINDOWS.items():
    _window_query(_name, _last)


@query(O.own_window_sql(10))
def window_stats_own10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_window_stats(_stored_results(spark, sf_dir), 10, FIRST, LAST)


@query(f"""WITH {O.RESULTS}, until AS (SELECT * FROM results WHERE CAST(date AS DATE) <= DATE '{O.SNAPSHOT_DATE}')
    SELECT DATE '{O.SNAPSHOT_DATE}' AS dt_ref, driverid, {O.METRIC_LIST} FROM until
    WHERE driverid IN (SELECT driverid FROM until WHERE year >= (SELECT max(year) - 2 FROM until))
    GROUP BY driverid""")
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_stats(_results(spark, sf_dir), O.SNAPSHOT_DATE)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(_stored_results(spark, sf_dir), year_start=FIRST, year_stop=LAST)


@query(f"WITH {O.WIDE} SELECT * FROM features")
def features_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


# Seasons and base table -----------------------------------------------------------------------------


@query(f"WITH {O.RESULTS}, {O.POINTS} SELECT * FROM season_points")
def points_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_points(_results(spark, sf_dir))


@query(f"WITH {O.RESULTS}, {O.RANKING} SELECT * FROM season_ranking")
def ranking_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_ranking(_results(spark, sf_dir))


@query(f"WITH {O.RESULTS}, {O.RANKING} SELECT * FROM champions")
def season_champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return champions(_results(spark, sf_dir))


def _abt(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _stored_results(spark, sf_dir)
    wide = feature_table(results, year_start=FIRST, year_stop=LAST)
    return abt(wide, champions(results), *ABT_RANGE)


def _short_abt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base table with one feature, for queries that read no other."""
    results = _stored_results(spark, sf_dir)
    last10 = window_stats(results, 10, FIRST, LAST).select(
        "dt_ref", "driverid", F.col("avg_gridposition").alias("avg_gridposition_last10")
    )
    return materialize(abt(last10, champions(results), *ABT_RANGE), "abt")


def _stored_abt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(_abt(spark, sf_dir), "abt")


@query(f"WITH {O.ABT} SELECT * FROM abt")
def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _abt(spark, sf_dir)


_RAW = O.RESULTS.replace("results AS", "raw AS", 1)
_CURRENT = f"""{_RAW}, {_CORRECTED.replace("FROM results", "FROM raw")},
results AS MATERIALIZED (
  SELECT * FROM corrected UNION ALL
  SELECT * FROM raw WHERE (year, roundnumber, mode) NOT IN (SELECT (year, roundnumber, mode) FROM corrected))"""


@query(f"WITH {O.ABT.replace(O.RESULTS, _CURRENT, 1)} SELECT * FROM abt")
def lake_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored flow on session files that do not say when they landed, then on corrections of every third round."""
    folder = new_folder(spark, "lake")
    lake, landing = Lake(spark, f"{folder}/tables"), f"{folder}/landing"
    first = _stored_results(spark, sf_dir)
    for rows in (first, _corrections(first)):
        rows.repartition(*SESSION_KEY).write.mode("append").partitionBy(*SESSION_KEY).parquet(landing)
        lake.ingest(landing)
    return lake.refresh(landing, *ABT_RANGE, year_start=FIRST, year_stop=LAST)


_LATE_CORRECTED = _CORRECTED.replace("FROM results", "FROM raw").replace("roundnumber % 3 = 0", "year = 1999 AND roundnumber % 6 = 0")
_LATE_CURRENT = f"""{_RAW}, {_LATE_CORRECTED},
results AS MATERIALIZED (
  SELECT * FROM corrected UNION ALL
  SELECT * FROM raw WHERE (year, roundnumber, mode) NOT IN (SELECT (year, roundnumber, mode) FROM corrected))"""


@query(f"WITH {O.ABT.replace(O.RESULTS, _LATE_CURRENT, 1)} SELECT * FROM abt")
def refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental flow: seasons up to 2000, then the last season, then corrections of two rounds of 1999."""
    folder, first = new_folder(spark, "incremental"), _stored_results(spark, sf_dir)
    lake = IncrementalLake(spark, f"{folder}/lake", year_start=FIRST, year_stop=LAST, start=ABT_RANGE[0], stop=ABT_RANGE[1])
    fixed = _corrections(first.where("year = 1999 AND roundnumber % 6 = 0"))
    for day, rows in enumerate((first.where(f"year < {LAST}"), first.where(f"year = {LAST}"), fixed), start=1):
        stamped = rows.withColumn("landed_at", _at(f"2001-01-0{day}"))
        stamped.repartition(*SESSION_KEY).write.mode("append").parquet(f"{folder}/landing")
        lake.ingest(f"{folder}/landing")
        lake.refresh()
    return lake.read("abt")


# Sampling -------------------------------------------------------------------------------------------

OOT = fixtures.OOT_YEAR
_YEARED = f"{O.SHORT_ABT}, yeared AS (SELECT *, year(dt_ref) AS year FROM abt)"
_WIDE_YEARED = f"{O.ABT}, yeared AS (SELECT *, year(dt_ref) AS year FROM abt)"
_DATES = f"""dated AS (SELECT year, dt_ref, row_number() OVER (PARTITION BY year ORDER BY dt_ref DESC) AS nth
  FROM (SELECT DISTINCT year, dt_ref FROM yeared WHERE year < {OOT}))"""
_SPLIT = f"""split AS (
  SELECT * EXCLUDE (nth, n), CASE WHEN nth <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM (
    SELECT *, count(*) OVER (PARTITION BY flchampion) AS n,
           row_number() OVER (PARTITION BY flchampion ORDER BY md5(concat_ws('|', '42', driverid, year))) AS nth
    FROM (SELECT DISTINCT driverid, year, flchampion FROM yeared WHERE year < {OOT})))"""
_SETS = f"""sets AS (
  SELECT y.*, s.split FROM yeared y JOIN split s USING (driverid, year, flchampion)
  JOIN dated d ON d.year = y.year AND d.dt_ref = y.dt_ref AND d.nth > 5
  UNION ALL SELECT *, 'oot' FROM yeared WHERE year >= {OOT})"""


@query(f"WITH {_WIDE_YEARED} SELECT * FROM yeared WHERE year >= {OOT}")
def oot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.out_of_time(_abt(spark, sf_dir), OOT)  # read once, so not stored


@query(f"WITH {_YEARED}, {_DATES} SELECT year, dt_ref FROM dated WHERE nth > 5")
def calendar_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.calendar_trim(_short_abt(spark, sf_dir), OOT)


@query(f"WITH {_YEARED} SELECT DISTINCT driverid, year, flchampion FROM yeared WHERE year < {OOT}")
def entity_year_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.entity_year_labels(_short_abt(spark, sf_dir), OOT)


@query(f"WITH {_YEARED}, {_SPLIT} SELECT * FROM split")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.group_split(_short_abt(spark, sf_dir), OOT)


@query(f"WITH {_WIDE_YEARED}, {_DATES}, {_SPLIT}, {_SETS} SELECT * FROM sets")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.training_sets(_stored_abt(spark, sf_dir), OOT)


@query(f"""WITH {_YEARED}, {_DATES}, {_SPLIT}, {_SETS}
    SELECT split, count(*) AS rows, avg(flchampion) AS label_rate FROM sets GROUP BY split""")
def split_label_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.label_rates(sampling.training_sets(_short_abt(spark, sf_dir), OOT))


@query(f"WITH {_WIDE_YEARED} SELECT * EXCLUDE year FROM yeared ORDER BY md5(concat_ws('|', '42', driverid, dt_ref)) LIMIT 5")
def model_input_example(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.example_rows(_abt(spark, sf_dir))  # read once, so not stored


# Profile, imputation, evaluation, model ---------------------------------------------------------------


@query(f"""WITH {O.ABT}, counts AS (SELECT {", ".join(f"count(*) - count({f}) AS {f}" for f in O.FEATURES)} FROM abt)
    SELECT * FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME feature VALUE nulls) WHERE nulls > 0""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _abt(spark, sf_dir)
    return evaluation.null_profile(base, sampling.feature_names(base))


@query(f"""WITH {O.ABT} SELECT dt_ref, driverid, flchampion,
    {", ".join(f"CAST(coalesce({f}, -10000) AS DOUBLE) AS {f}" for f in O.FEATURES)} FROM abt""")
def imputed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _abt(spark, sf_dir)
    return evaluation.impute(base, sampling.feature_names(base))


_SCORED = f"""{O.SHORT_ABT}, scores AS (
    SELECT 30 - avg_gridposition_last10 AS score, sum(flchampion) AS p, count(*) - sum(flchampion) AS n
    FROM abt WHERE avg_gridposition_last10 IS NOT NULL GROUP BY 1)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short_abt(spark, sf_dir).withColumn("score", 30 - F.col("avg_gridposition_last10"))


@query(f"""WITH {_SCORED} SELECT sum(p * (below + n / 2)) / (sum(p)::DOUBLE * sum(n)) AS auc FROM (
    SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM scores)""")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.auc(_scored(spark, sf_dir), "score", unscored="skip")


@query(f"""WITH {_SCORED} SELECT score AS threshold, fp::DOUBLE / nn::DOUBLE AS fpr, tp::DOUBLE / pp::DOUBLE AS tpr FROM (
      SELECT score, p, n, sum(p) OVER so_far AS tp, sum(n) OVER so_far AS fp, sum(p) OVER () AS pp, sum(n) OVER () AS nn,
             lead(p) OVER falling AS next_p, lead(n) OVER falling AS next_n, lag(p) OVER falling AS last_p
      FROM scores WINDOW falling AS (ORDER BY score DESC),
        so_far AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE next_p IS NULL OR next_p <> p OR next_n <> n OR last_p IS NULL
    UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.roc_points(_scored(spark, sf_dir), "score", unscored="skip")


def _fitted(spark: SparkSession, sf_dir: str):
    base = materialize(_abt(spark, sf_dir), "abt")
    # Limits and late dates are small: deciding the split of a stored row again costs less than storing the wide rows again.
    sets = sampling.training_sets(base, OOT)
    train = sets.where(F.col("split") == "train")
    return sets, forest.fit(train, sampling.feature_names(sets))


_LOW_GRID = "coalesce(avg_gridposition_last10 <= 11, FALSE)"


@query(f"""WITH {O.SHORT_ABT}
    SELECT dt_ref, driverid, avg(flchampion) OVER (PARTITION BY {_LOW_GRID}) AS proba FROM abt""")
def model_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree on one yes-or-no feature, fitted, stored, loaded and applied: its leaves are the label's means."""
    rows = _short_abt(spark, sf_dir).withColumn("low_grid", F.expr(_LOW_GRID).cast("long"))
    fitted = forest.fit(rows, ["low_grid"], trees=1, min_leaf=1, max_depth=1, bootstrap=False)
    folder = new_folder(spark, "models")
    forest.save_version(fitted, spark, folder)
    return forest.score(forest.load_latest(spark, folder), rows)


_MANY_POINTS = "coalesce(qtde_points > 20, FALSE)"


@query(f"""WITH {O.TREE_ABT}, marked AS (SELECT *, avg_gridposition > -10000 AND avg_gridposition <= 11 AS low, qtde_points > 20 AS many FROM abt)
    SELECT dt_ref, driverid, CASE WHEN year(dt_ref) < 1999 THEN 1 ELSE 2 END AS version,
           CASE WHEN year(dt_ref) < 1999 THEN avg(flchampion) OVER (PARTITION BY low) ELSE avg(flchampion) OVER (PARTITION BY many) END AS proba
    FROM marked""")
def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come in two parts, each scored by the newest model of its time."""
    rows = _tree_rows(spark, sf_dir)
    rows = rows.withColumns({"low": F.expr("coalesce(avg_gridposition <= 11, FALSE)").cast("long"), "many": F.expr(_MANY_POINTS).cast("long")})
    folder = new_folder(spark, "scored")
    models, source, target = (f"{folder}/{name}" for name in ("models", "source", "scores"))
    early = F.year("dt_ref") < 1999
    for feature, part in (("low", early), ("many", ~early)):
        fitted = forest.fit(rows, [feature], trees=1, min_leaf=1, max_depth=1, bootstrap=False)
        forest.save_version(fitted, spark, models)
        rows.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        score_following(spark, stream, models, target, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(target).select("dt_ref", "driverid", "version", "proba")


def _tree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _stored_results(spark, sf_dir)
    last10 = window_stats(results, 10, FIRST, LAST).select("dt_ref", "driverid", *O.TREE_FEATURES)
    return materialize(abt(last10, champions(results), *ABT_RANGE), "tree_abt")


def _grown(rows: DataFrame) -> DataFrame:
    return tree.grow_tree(rows, O.TREE_FEATURES, O.TREE_DEPTH, O.TREE_LEAF)


@query(f"WITH {O.TREE} SELECT * FROM tree")
def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(_tree_rows(spark, sf_dir))


@query(f"""WITH {O.TREE} SELECT dt_ref, driverid, positives / rows AS proba FROM passed JOIN tree USING (node) WHERE feature IS NULL""")
def tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tree_rows(spark, sf_dir)
    return tree.score_tree(_grown(rows), rows)


_SUMMED = "list_reduce(list_sort(list(decrease)), lambda a, b: a + b)"


@query(f"""WITH {O.TREE}, own AS (SELECT feature, {_SUMMED} AS own FROM tree WHERE feature IS NOT NULL GROUP BY feature)
    SELECT feature, coalesce(own / (SELECT {_SUMMED} FROM tree WHERE feature IS NOT NULL), 0) AS importance
    FROM (SELECT unnest([{", ".join(f"'{m}'" for m in O.TREE_FEATURES)}]) AS feature) LEFT JOIN own USING (feature)""")
def tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.tree_importances(_grown(_tree_rows(spark, sf_dir)), O.TREE_FEATURES)


@query(f"""WITH {O.SHORT_ABT}, scores AS (
    SELECT proba, sum(flchampion) AS p, count(*) - sum(flchampion) AS n
    FROM (SELECT flchampion, avg(flchampion) OVER (PARTITION BY {_LOW_GRID}) AS proba FROM abt) GROUP BY proba)
  SELECT sum(p * (below + n / 2)) / (sum(p)::DOUBLE * sum(n)) AS auc FROM (
    SELECT *, coalesce(sum(n) OVER (ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scores)""")
def model_one_split_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, score and judge in a row, on the same tree of one split."""
    rows = _short_abt(spark, sf_dir).withColumn("low_grid", F.expr(_LOW_GRID).cast("long"))
    fitted = forest.fit(rows, ["low_grid"], trees=1, min_leaf=1, max_depth=1, bootstrap=False)
    return evaluation.auc(forest.with_probability(fitted, rows), "proba")


@query()
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.feature_importances(_fitted(spark, sf_dir)[1], spark)


@query()
def model_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, model = _fitted(spark, sf_dir)
    return forest.evaluate(model, sets)


@query()
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on everything, store as a version, load the latest and score."""
    base = materialize(_abt(spark, sf_dir), "abt")
    folder = new_folder(spark, "models")
    forest.save_version(forest.fit_final(base), spark, folder)
    return forest.score(forest.load_latest(spark, folder), base)
