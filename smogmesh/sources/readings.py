"""Readings sources: the CSV reader and the readings view over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogmesh.schema import CORRUPT_COLUMN, READING_COLUMNS, READINGS


def load_readings(spark: SparkSession, path: str, *, infer: bool = False) -> DataFrame:
    """Read a readings CSV with a header; blank fields become null.

    The schema is fixed (no extra pass over the file); ``infer=True`` restores
    type inference for files whose layout is not known in advance.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(READINGS).csv(path)


def read_readings(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """Like ``load_readings``, with the text of every line that does not fit the schema in ``_corrupt_record``.

    Such a line (too few or too many fields, or a value of the wrong type) still
    gives the fields that could be read.  ``accepted`` and ``rejected`` part the two.
    """
    schema = T.StructType([*READINGS.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(path)
    # The parser only judges the fields that a query asks for.  As fields of one struct they are all
    # asked for, so that a line is accepted or rejected alike whatever is selected later.
    return rows.select(F.inline(F.array(F.struct(*schema.names))))


def accepted(rows: DataFrame) -> DataFrame:
    """Rows whose line fits the schema, as readings."""
    return rows.filter(F.col(CORRUPT_COLUMN).isNull()).select(*READING_COLUMNS)


def _reason() -> Column:
    line = F.col(CORRUPT_COLUMN)
    # Commas inside quotes separate nothing.
    fields = F.length(F.regexp_replace(F.regexp_replace(line, '"[^"]*"', ""), "[^,]", "")) + 1
    n = len(READING_COLUMNS)
    return F.when(line.isNull(), None).when(fields < n, "short").when(fields > n, "long").otherwise("value")


def rejected(rows: DataFrame) -> DataFrame:
    """Rows whose line does not fit, with ``reason``: ``short`` or ``long`` by the number of fields, else ``value``."""
    return rows.filter(F.col(CORRUPT_COLUMN).isNotNull()).withColumn("reason", _reason())


def line_report(rows: DataFrame) -> DataFrame:
    """``reason, rows, with_station``: lines per reason for rejection (null: accepted), and how many gave a station id."""
    own = rows.withColumn("reason", _reason()).groupBy("reason")
    return own.agg(F.count(F.lit(1)).alias("rows"), F.count("station_id").alias("with_station"))


def write_readings_csv(df: DataFrame, path: str) -> None:
    """Write readings as headered CSV files (null → empty field)."""
    df.select(*READING_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nulled(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def readings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings table derived from the ``events`` and ``region`` test tables.

    One reading per event, the station being the event's user and the city the
    user's region; pollutant values are derived from ``value`` and the JSON
    field ``k``.  About 1 % of the rows appear twice (exact copies) and some
    fields are blank, so cleaning has work to do.  A single scan of
    ``events``, no self-union.

    The view is lazy: every query reads its tables anew, and only the columns
    it needs.
    """
    events = _table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # Stage 1: parse the JSON field, the hour and the line number once per event.
    # Keeping them as named columns stops the optimizer from copying the
    # expressions into every derived column (and into inferred constraints).
    uid = F.col("user_id")
    joined = events.join(region, region.r_regionkey == (uid % 5), "inner").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "r_name",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.hour(F.col("ts").cast("timestamp_ntz")).alias("h"),
        ((uid / 10).cast("long") % 2).cast("string").alias("line_no"),
    )
    eid, k, value, ts, hour, line_no = (F.col(c) for c in ("event_id", "k", "value", "ts", "h", "line_no"))

    cols = {
        "station_id": uid.cast("int"),
        "station_name": F.concat(F.col("r_name"), F.lit("-L"), line_no, F.lit("-S"), uid.cast("string")),
        "city": F.col("r_name"),
        "latitude": (F.lit(40.0) + (uid % 5) * 1.0 + (uid % 13) * 0.01).cast("double"),
        "longitude": (F.lit(2.0) + (uid % 5) * 1.0 + (uid % 11) * 0.01).cast("double"),
        "line": F.when(
            (uid % 7 == 0) & (uid % 5 < 2) & (F.col("event_type") == "error"), F.lit("LX")
        ).otherwise(F.concat(F.lit("L"), line_no)),
        # Epoch milliseconds of the UTC wall clock, from date and time parts of
        # the timestamp_ntz: independent of the session time zone.
        "timestamp": (
            F.unix_date(F.to_date(ts)).cast("long") * 86_400_000
            + F.hour(ts).cast("long") * 3_600_000
            + F.minute(ts).cast("long") * 60_000
            + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long")
        ),
        "hour": hour.cast("int"),
        "day_of_week": (F.weekday(ts) + 1).cast("int"),
        "month": F.month(ts).cast("int"),
        "pm25": _nulled(
            eid % 50 == 7,
            F.when(hour.between(1, 4) & (eid % 10 != 3), F.lit(0))
            .when(eid % 211 == 0, F.lit(0))
            .otherwise(F.floor(value * 0.8)),
        ).cast("int"),
        "pm10": _nulled(eid % 50 == 11, F.floor(value * 0.7) + k % 40).cast("int"),
        "co2": _nulled(eid % 50 == 13, F.lit(400) + k * 8 + F.floor(value)).cast("int"),
        "no2": _nulled(eid % 50 == 17, F.floor(value * 0.3) + k % 30).cast("int"),
        "o3": F.when(eid % 97 == 0, F.lit(210)).otherwise(k % 60).cast("int"),
        "noise": (F.lit(30) + (k * 7) % 55).cast("int"),
        "humidity": _nulled(eid % 50 == 19, F.lit(40) + k % 60).cast("int"),
        "temperature": _nulled(
            eid % 50 == 23,
            F.when(eid % 99 == 0, F.lit(60)).when(eid % 101 == 0, F.lit(-15)).otherwise(F.lit(5) + k % 30),
        ).cast("int"),
        "wind_speed": _nulled(eid % 50 == 29, value / 50.0).cast("double"),
        "rain": F.when((F.lit(40) + k % 60 > 70) & (eid % 5 < 2), F.lit(1)).otherwise(F.lit(0)).cast("int"),
    }
    # About 1 % of the events are read twice: exact copies for the dedupe step.
    times = F.explode(F.sequence(F.lit(1), F.when(eid % 100 == 1, 2).otherwise(1)))
    return joined.select("*", times.alias("_copy")).select(*[c.alias(n) for n, c in cols.items()])
