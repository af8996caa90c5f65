"""Incremental append of result files, and scoring of a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seasonstats.operators.model import DEFAULT_ID, latest_version, load_version, score
from seasonstats.schema import LANDED, SESSION_KEY
from seasonstats.sources.results import normalise


def stream_results(
    spark: SparkSession,
    source: str,
    schema: T.StructType = LANDED,
    clean: str = "off",
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New parquet files under ``source``. ``clean='delete'`` or ``'archive'`` removes or moves files once
    their batch is committed; a file whose removal fails stays and the stream goes on."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(source)
    if "landed_at" in schema.names:  # files that do not say when they landed have the file's own time
        rows = rows.withColumn("landed_at", F.coalesce("landed_at", F.col("_metadata.file_modification_time")))
    return normalise(rows, schema)


def append_table(
    rows: DataFrame, target: str, checkpoint: str, every: str | None = None, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append a stream to a stored table: all that is there now, or for ever at an interval ('6 hours').

    The checkpoint makes each file arrive once, also after a failed run.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(target)


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, **options) -> None:
    """One incremental run: append the files that came since the last run, then end. The table is partitioned by
    session, so that a season or a round is read alone."""
    append_table(
        stream_results(spark, source, **options), target, checkpoint, partition_by=SESSION_KEY
    ).awaitTermination()


def score_stream(
    model: PipelineModel,
    rows: DataFrame,
    target: str,
    checkpoint: str,
    id_columns: tuple[str, ...] = DEFAULT_ID,
    every: str | None = None,
) -> StreamingQuery:
    return append_table(score(model, rows, id_columns), target, checkpoint, every)


def score_following(
    spark: SparkSession,
    rows: DataFrame,
    models: str,
    target: str,
    checkpoint: str,
    id_columns: tuple[str, ...] = DEFAULT_ID,
    every: str | None = None,
) -> StreamingQuery:
    """Score every batch of a stream with the model that is the newest when the batch comes, and store the version with
    the scores. A batch that is run again replaces what it has written, as a whole with the model of that time.
    """
    loaded: dict[int, PipelineModel] = {}

    def take(batch: DataFrame, number: int) -> None:
        version = latest_version(spark, models)
        if version not in loaded:
            loaded.clear()
            loaded[version] = load_version(spark, models, version)
        if batch.isEmpty():
            return
        scored = score(loaded[version], batch, id_columns).withColumn("version", F.lit(version))
        scored.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
