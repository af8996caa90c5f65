"""A stream of landed files kept as current rows: the newest landing of every session, changed session by session.

The stream carries the files themselves, so that how a file stores its times is known before Spark reads it: files
with times in nanoseconds, as pandas writes them, are read as whole numbers and cut to microseconds, all others as
they are. A batch then touches only the sessions that it brings; nothing that was stored before is read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstats.schema import LANDED, SESSION_KEY
from seasonstats.sources.results import micros_from_nanos, normalise
from seasonstats.sources.shared import materialize, new_folder
from seasonstats.sources.versions import VersionedTable, same

_FILES = "path string, modificationTime timestamp, length long, content binary"
_NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def current_table(spark: SparkSession, root: str) -> VersionedTable:
    """Current rows by session; the list of files keeps when a session landed and its days."""
    facts = {
        "landed": (F.max("landed_at"), "timestamp"),
        "days": (F.collect_set(F.to_date("date")), "array<date>"),
    }
    return VersionedTable(spark, root, tuple(SESSION_KEY), LANDED, facts)


def _footer() -> Column:
    """The end of a Parquet file, which says how its columns are stored: its length stands before the last four bytes."""
    digits = F.hex(F.substring("content", -8, 4))
    turned = F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])
    size = F.conv(turned, 16, 10).cast("int") + 8
    return F.substring("content", -size, size)


def _nano_columns() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of its own, which executors can run without this package."""

    def nano_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path, footer in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    schema = pq.read_metadata(pa.BufferReader(footer)).schema
                except Exception as error:
                    raise ValueError(f"{path} is no Parquet file") from error
                columns = (schema.column(i) for i in range(len(schema)))
                found.append([c.name for c in columns if c.physical_type == "INT64" and "nanoseconds" in str(c.logical_type)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["path", "nanos"])

    return nano_columns


def _read_kind(spark: SparkSession, source: str, paths: list[str], nanos: frozenset[str], schema: T.StructType) -> DataFrame:
    """Files that store the same columns in nanoseconds."""
    fields = [T.StructField(f.name, T.LongType() if f.name in nanos else f.dataType) for f in schema.fields]
    rows = spark.read.schema(T.StructType(fields)).option("basePath", source).parquet(*paths)
    if "landed_at" in schema.names:
        own = F.expr("timestamp_micros(landed_at DIV 1000)") if "landed_at" in nanos else F.col("landed_at")
        rows = rows.withColumn("landed_at", F.coalesce(own, F.col("_metadata.file_modification_time")))
    cut = {name: micros_from_nanos(F.col(name)) for name in nanos if name != "landed_at"}
    return normalise(rows.withColumns(cut) if cut else rows, schema)


def read_landed(spark: SparkSession, source: str, files: DataFrame, schema: T.StructType = LANDED) -> DataFrame:
    """The rows of landed files (path and content, as Spark's ``binaryFile`` has them), stored in microseconds.

    Files lie in folders by session, all or none of them, and each stores its times in any unit. Only the ends of the contents leave
    the JVM. The paths of the files come to the driver, as they do for any file stream.
    """
    found = files.select("path", _footer().alias("footer")).mapInArrow(_nano_columns(), "path string, nanos array<string>")
    wanted, kinds, root = set(schema.names), {}, source.split(":", 1)[-1].rstrip("/")
    for path, nanos in found.toLocalIterator():
        inside = path.split(root, 1)[-1].split("/")[:-1]
        folders = tuple(part.split("=")[0] for part in inside if "=" in part)
        kind = frozenset(n.lower() for n in nanos) & wanted
        kinds.setdefault((folders, kind), []).append(path)
    # A session of its own, as the setting holds for all that a session reads.
    apart = spark.newSession()
    apart.conf.set(_NANOS_AS_LONG, "true")
    apart.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    parts = []
    for (_, nanos), paths in kinds.items():
        if nanos:
            folder = new_folder(spark, "landed_nanos")
            _read_kind(apart, source, paths, nanos, schema).write.parquet(folder)
            parts.append(spark.read.schema(schema).parquet(folder))
        else:
            parts.append(_read_kind(spark, source, paths, nanos, schema))
    rows = parts[0] if parts else spark.createDataFrame([], schema)
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows


def upsert(table: VersionedTable, rows: DataFrame, source: str, batch: int) -> bool:
    """Let a batch of landed rows replace the sessions that it has a newer landing of; False if the batch was taken before.

    Of a session's landings in the batch the newest counts. It replaces an older one, is added to one of the same time
    (a landing in several files may come in several batches), and is left out if a newer one is stored. Rows without a
    landing time are a landing older than all others.
    """
    base = table.latest()
    if table.applied(base).get(source, -1) >= batch:
        return False
    keys = list(table.keys)
    rows = materialize(rows, "batch")
    newest = rows.groupBy(*keys).agg(F.max("landed_at").alias("landed"))
    stored = table.files(base).groupBy(*keys).agg(F.max("landed").alias("stored"), F.lit(True).alias("held"))
    older = F.col("stored") < F.col("landed")
    none = F.col("held").isNull()
    compared = newest.alias("n").join(stored.alias("s"), same("n", "s", keys), "left").select(
        *[F.col(f"n.{k}") for k in keys], "landed",
        (none | older | (F.col("stored").isNull() & F.col("landed").isNotNull())).alias("replaces"),
        F.col("stored").eqNullSafe(F.col("landed")).alias("adds"),
    )
    taken = materialize(compared.where("replaces OR adds"), "sessions")  # a row per session of the batch
    named = taken.select(*[F.col(k).alias(f"{k}__of") for k in keys], "landed")
    of_session = F.col("landed_at").eqNullSafe(F.col("landed"))
    for k in keys:
        of_session = of_session & F.col(k).eqNullSafe(F.col(f"{k}__of"))
    kept = rows.join(named, of_session, "left_semi").hint("rebalance", *[F.col(k) for k in keys])
    table.commit(kept, taken.where("replaces").select(*keys), {source: batch}, base)
    return True


def keep_current(
    spark: SparkSession, source: str, table: VersionedTable, checkpoint: str, every: str | None = None, clean: str = "off",
    archive: str | None = None, max_files: int | None = None,
):
    """Start the stream from ``source`` to current rows: all files there now, or for ever at an interval ('6 hours').

    A batch that is run again after a failure changes nothing that it has changed before. ``clean`` is as for
    ``stream_results``.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.parquet").option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(source)

    def take(batch: DataFrame, number: int) -> None:
        if table.applied().get(checkpoint, -1) < number:
            upsert(table, read_landed(spark, source, batch), checkpoint, number)

    writer = files.select("path", "content").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
