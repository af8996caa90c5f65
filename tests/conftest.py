from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from seasonstats.schema import RESULTS  # noqa: E402
from seasonstats.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session("seasonstats-tests", cpus=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def row(day, driver, year=None, round_=1, mode="Race", status="Finished", pos=1.0, grid=1.0, points=0.0):
    """One result; ``day`` is an ISO date or None."""
    date = None if day is None else dt.datetime.fromisoformat(day) + dt.timedelta(hours=14)
    year = (None if date is None else date.year) if year is None else year
    return (year, round_, mode, date, driver, status, pos, grid, points, None, None, None, None)


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, RESULTS)


def rows_of(df):
    """Rows as sorted tuples with columns in the order of their names."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr), [names[i] for i in order]


def duck_results(rows):
    """A DuckDB connection with ``rows`` as table results."""
    columns = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int64(), pa.string(), pa.timestamp("us"), pa.string(), pa.string()] + [pa.float64()] * 3
    arrays = [pa.array(c, t) for c, t in zip(columns[:9], types, strict=True)]
    frame = pa.table(arrays, names=[f.name for f in RESULTS.fields[:9]])
    con = duckdb.connect()
    con.register("frame", frame)
    con.execute("CREATE TABLE results AS SELECT * FROM frame")
    return con
