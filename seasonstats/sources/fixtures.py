"""Results-shaped tables derived from the TPC-H-like test tables.

A supplier is a competitor, a month is a round, ``l_linestatus`` is the session mode. Places come from the
sums of prices and quantities by arithmetic, not from a ranking over a session, so a session of any size
needs one aggregation only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstats.schema import RACE, SPRINT

YEARS = (1995, 2001)
OOT_YEAR = 2001
FIRST_CAREER = 1990  # careers are counted from a year before all data


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _session_date(year: Column, month: Column, mode: Column) -> Column:
    # The race is held on day 15 of the month, the sprint the day before.
    day = F.when(mode == RACE, 15).otherwise(14)
    return F.make_date(year.cast("int"), month.cast("int"), day).cast("timestamp_ntz")


FLAG_A, FLAG_N, FLAG_R = 1, 3, 5


def _flag_place(flag: Column) -> Column:
    """Place of any flag among A, N and R. The place of the least flag is the least place, and numbers are added up by hash,
    where the least of strings would have all rows sorted."""
    place = F.when(flag < "A", 0).when(flag == "A", FLAG_A).when(flag < "N", 2).when(flag == "N", FLAG_N)
    return place.when(flag < "R", 4).when(flag == "R", FLAG_R).when(flag > "R", 6)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = read(spark, sf_dir, "lineitem")
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    sums = (
        item.groupBy(
            "l_suppkey",
            year.cast("long").alias("year"),
            month.cast("long").alias("roundnumber"),
            F.when(F.col("l_linestatus") == "O", RACE).otherwise(SPRINT).alias("mode"),
        )
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
            F.sum("l_quantity").cast("long").alias("quantity"),
            F.min(_flag_place(F.col("l_returnflag"))).alias("flag"),
        )
    )
    # Every row counts. A supplier is a new competitor after one to five seasons, so that competitors come and go.
    career = F.floor((F.col("year") - FIRST_CAREER + F.col("l_suppkey") % 4) / (1 + F.col("l_suppkey") % 5))
    place = ((F.col("price") * 100).cast("long") % 22 + 1).cast("double")
    retired = (F.col("flag") == FLAG_R) & (F.col("l_suppkey") % 2 == 0)
    race_points = F.when(F.col("place") <= 10, 11 - F.col("place"))
    sprint_points = F.when(F.col("place") <= 8, (9 - F.col("place")) * 0.5)
    return sums.withColumn("place", place).select(
        "year",
        "roundnumber",
        "mode",
        _session_date(F.col("year"), F.col("roundnumber"), F.col("mode")).alias("date"),
        F.concat_ws("-", F.col("l_suppkey").cast("string"), career.cast("string")).alias("driverid"),
        F.when(F.col("flag") == FLAG_A, "Finished").when(F.col("flag") == FLAG_N, "+1 Lap").otherwise("Retired").alias("status"),
        F.when(~retired, F.col("place")).alias("position"),
        ((F.col("quantity") + F.col("l_suppkey")) % 23).cast("double").alias("gridposition"),
        F.coalesce(F.when(F.col("mode") == RACE, race_points).otherwise(sprint_points), F.lit(0.0)).alias("points"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session metadata: every session held, with the nation whose key is the month as its country."""
    held = results(spark, sf_dir).select("year", "roundnumber", "mode", "date").distinct()
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("roundnumber"), F.col("n_name").alias("country"), F.col("r_name").alias("location")
    )
    return held.join(places, "roundnumber").select(
        "year",
        "roundnumber",
        "mode",
        F.format_string("%s ROUND %02d OF %d", F.upper("mode"), "roundnumber", "year").alias("officialeventname"),
        F.format_string("Round %02d", "roundnumber").alias("eventname"),
        "country",
        "location",
    )


def land_nanos(rows: DataFrame, folder: str) -> int:
    """Write each session into a file of its own under ``folder`` (a URI), its date in nanoseconds, 789 of them past the
    microsecond, as pandas would; returns the number of files."""

    def write(key, table):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        place = table.schema.get_field_index("date")
        nanos = pa.array([v * 1000 + 789 for v in table.column("date").cast(pa.int64()).to_pylist()], pa.int64())
        table = table.set_column(place, "date", nanos.cast(pa.timestamp("ns")))
        name = "_".join(str(k.as_py()) for k in key)
        with system.open_output_stream(f"{root}/{name}.parquet") as out:
            pq.write_table(table, out, version="2.6")
        return pa.table({"files": pa.array([1], pa.int64())})

    written = rows.groupBy("year", "roundnumber", "mode").applyInArrow(write, "files long")
    return written.agg(F.sum("files")).first()[0] or 0
