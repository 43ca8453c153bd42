"""Streaming severity and alerts over a folder of sensor CSV drops.

One streaming plan, one ``foreachBatch`` sink: each micro-batch is persisted
once and written to three feeds (abnormal readings, danger alerts, rejected
rows).  Rows that do not fit the schema are reported as rejected *and* judged
by what could be read of them.  Writes go to ``run=<query id>/batch_id=<n>``
folders in overwrite mode, so a batch replayed after a failure replaces its own
output instead of duplicating it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smogmesh.functions.indices import severity, who_index
from smogmesh.schema import CORRUPT_COLUMN, SENSOR, SENSOR_COLUMNS, SEVERITY_LABELS

DANGER, RAISED, NORMAL = SEVERITY_LABELS


def sensor_schema(with_corrupt: bool = True) -> T.StructType:
    fields = list(SENSOR.fields)
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType()))
    return T.StructType(fields)


def read_sensors(spark: SparkSession, path: str, *, glob: str = "sensor_*.csv", max_files: int | None = None) -> DataFrame:
    """Stream headerless sensor CSV files; lines that do not fit keep their text in ``_corrupt_record``.

    Such a line still gives the fields that could be read.  Every sink reports
    ``rows`` and ``odd_rows`` per batch under ``sensor_rows`` in the query's
    observed metrics.
    """
    reader = (
        spark.readStream.schema(sensor_schema())
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("pathGlobFilter", glob)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(path)
    odd = F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("odd_rows")
    return rows.observe("sensor_rows", F.count(F.lit(1)).alias("rows"), odd)


def with_severity(df: DataFrame, *, unknown_label: str | None = None) -> DataFrame:
    """Add ``pollution_index`` (null if any pollutant is missing) and ``severity``."""
    return df.withColumn("pollution_index", who_index(nulls="null")).withColumn(
        "severity", severity(F.col("pollution_index"), unknown_label=unknown_label)
    )


def _rejected(df: DataFrame) -> F.Column:
    # A line the parser could not map onto the sensor schema.
    if CORRUPT_COLUMN in df.columns:
        return F.col(CORRUPT_COLUMN).isNotNull()
    return F.lit(False)


def abnormal(df: DataFrame) -> DataFrame:
    """Readings whose severity is not normal (works on batch and streaming frames)."""
    return with_severity(df).filter(F.col("severity") != NORMAL).select(
        *SENSOR_COLUMNS, "pollution_index", "severity"
    )


def alerts(df: DataFrame) -> DataFrame:
    """Readings in the danger band."""
    return with_severity(df).filter(F.col("severity") == DANGER).select(
        *SENSOR_COLUMNS, "pollution_index", "severity"
    )


def _batch_writer(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # A query keeps its id as long as its checkpoint: a new checkpoint never
        # writes over an older run's folders.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        place = f"run={run}/batch_id={batch_id}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            abnormal(batch).write.mode("overwrite").parquet(f"{out}/abnormal/{place}")
            danger = alerts(batch)
            if not danger.isEmpty():
                danger.write.mode("overwrite").parquet(f"{out}/alerts/{place}")
            if CORRUPT_COLUMN in batch.columns:
                bad = batch.filter(_rejected(batch))
                if not bad.isEmpty():
                    bad.write.mode("overwrite").parquet(f"{out}/rejected/{place}")
        finally:
            batch.unpersist()

    return write


def run_alerts(
    stream: DataFrame,
    out: str,
    *,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the alert job.  ``checkpoint`` is required: it makes restarts exactly-once.

    ``trigger`` is passed to ``DataStreamWriter.trigger``; default
    ``{"processingTime": "10 seconds"}``, tests use ``{"availableNow": True}``.
    """
    writer = stream.writeStream.foreachBatch(_batch_writer(out)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_feed(
    rows: DataFrame,
    *,
    fmt: str = "parquet",
    path: str | None = None,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append-mode sink for one feed (e.g. ``abnormal(stream)``): parquet, memory or console.

    File sinks are exactly-once through their checkpoint and commit log.
    """
    writer = rows.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "console":
        writer = writer.option("truncate", False)
    if name or fmt == "memory":
        writer = writer.queryName(name or "feed")
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.start(path) if path else writer.start()


def run_separate(
    stream: DataFrame, out: str, *, checkpoint: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """The two feeds as two independent append queries on one source.

    Each query lists and reads the source on its own (every file is read
    twice); ``run_alerts`` does the same work with one read per batch.
    Wait on both with ``spark.streams.awaitAnyTermination()``.
    """
    return [
        start_feed(abnormal(stream), path=f"{out}/abnormal", checkpoint=f"{checkpoint}/abnormal", trigger=trigger),
        start_feed(alerts(stream), path=f"{out}/alerts", checkpoint=f"{checkpoint}/alerts", trigger=trigger),
    ]


def read_feed(spark: SparkSession, out: str, feed: str) -> DataFrame:
    """Read one output feed back as a batch DataFrame (run and batch dropped)."""
    schema = T.StructType(
        list(SENSOR.fields)
        + [T.StructField("pollution_index", T.DoubleType()), T.StructField("severity", T.StringType())]
    )
    try:
        return spark.read.schema(schema).parquet(f"{out}/{feed}").select(*schema.names)
    except Exception as exc:  # no batch wrote this feed
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def write_sensor_files(readings: DataFrame, folder: str, *, files: int | None = None) -> None:
    """Write the sensor columns of a readings table as headerless CSV drops, one per task by default."""
    rows = readings.select(*SENSOR_COLUMNS)
    (
        (rows.repartition(files) if files else rows)
        .write.mode("overwrite")
        .option("header", False)
        .csv(folder)
    )
