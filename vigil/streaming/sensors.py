"""Sensor workload (S3, S10, S11, K1, K2, A12, T1-T5): JSON landing zone ->
bronze table (append) -> sliding-window aggregate (append after watermark).

Both streams use the ``availableNow`` trigger against a checkpoint in the
shared checkpoint folder, so a run drains what has landed and stops, and a
restarted run (or a lost executor) resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas

# Fixed values of the sensor workload.
REGIONS = ["us-east-1", "us-west-2", "eu-west-1", "ap-southeast-1"]
FACILITIES = ["plant-A", "plant-B", "warehouse-C", "lab-D"]
SENSORS = 50
WATERMARK = "30 seconds"
WINDOW = "1 minute"
SLIDE = "30 seconds"
EVENT_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _normal(seed_col, salt: int):
    """Standard-normal value from a hash of the row key (Box-Muller over two
    hash-derived uniforms): reproducible, no driver state, any partitioning."""
    u1 = (F.abs(F.xxhash64(seed_col, F.lit(salt))) % 1_000_000 + 1) / 1_000_001.0
    u2 = (F.abs(F.xxhash64(seed_col, F.lit(salt + 1))) % 1_000_000) / 1_000_000.0
    return F.sqrt(-2 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)


def generate_readings(keys: DataFrame, key: str, base_time: str) -> DataFrame:
    """One synthetic reading per input row: sensor from 50, gaussian
    temperature (72, 8), humidity (45, 12), pressure (1013.25, 5) at two
    decimals, event time within +-5 s of ``base_time`` (column or literal)."""
    k = F.col(key)
    base = F.col(base_time) if base_time in keys.columns else F.to_timestamp(F.lit(base_time))
    jitter_ms = (F.abs(F.xxhash64(k, F.lit(7))) % 10001) - 5000
    et = F.timestamp_micros(F.unix_micros(base) + jitter_ms * 1000)
    return keys.select(
        F.format_string("sensor-%04d", (F.abs(F.xxhash64(k, F.lit(1))) % SENSORS + 1).cast("int")).alias("sensor_id"),
        F.round(72.0 + 8.0 * _normal(k, 11), 2).alias("temperature"),
        F.round(45.0 + 12.0 * _normal(k, 13), 2).alias("humidity"),
        F.round(1013.25 + 5.0 * _normal(k, 17), 2).alias("pressure"),
        F.date_format(et, EVENT_TIME_TEXT).alias("event_time"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.abs(F.xxhash64(k, F.lit(3))) % 4 + 1).cast("int")).alias("region"),
        F.element_at(F.array(*[F.lit(f) for f in FACILITIES]), (F.abs(F.xxhash64(k, F.lit(5))) % 4 + 1).cast("int")).alias("facility"),
    )


def readings_from_events(events: DataFrame) -> DataFrame:
    """Sensor source rows taken from the event table: sensor = user,
    region = event type, temperature = value, humidity = value / 2."""
    return events.select(
        F.format_string("sensor-%04d", F.col("user_id").cast("int")).alias("sensor_id"),
        F.col("value").alias("temperature"),
        (F.col("value") / 2).alias("humidity"),
        (F.lit(1000.0) + F.col("value") / 10).alias("pressure"),
        F.date_format(F.col("ts").cast("timestamp"), EVENT_TIME_TEXT).alias("event_time"),
        F.col("event_type").alias("region"),
        F.element_at(F.array(*[F.lit(f) for f in FACILITIES]), (F.col("event_id") % 4 + 1).cast("int")).alias("facility"),
    )


def write_landing(readings: DataFrame, landing_dir: str) -> None:
    """Append one JSON-lines drop to the landing zone."""
    readings.write.mode("append").json(landing_dir)


def bronze_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: file-source stream of the landing zone with the fixed schema."""
    r = spark.readStream.schema(schemas.SENSOR_SOURCE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.json(landing_dir)
    return raw.select(
        "sensor_id",
        "temperature",
        "humidity",
        "pressure",
        F.try_to_timestamp(F.col("event_time")).alias("event_time"),
        "region",
        "facility",
        F.current_timestamp().alias("ingestion_ts"),
    )


def run_ingest(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint: str, max_files_per_trigger: int | None = None):
    """K1: append the landing zone to the bronze table (availableNow)."""
    q = (
        bronze_stream(spark, landing_dir, max_files_per_trigger)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName("sensor_ingest")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze_dir)
    )
    q.awaitTermination()
    return q


def window_aggregate(bronze: DataFrame) -> DataFrame:
    """A12 + T1 + T2: 1-minute windows sliding by 30 s per region, after a
    30 s watermark.  State holds only open windows; the shuffle is on
    (window, region)."""
    agg = (
        bronze.withWatermark("event_time", WATERMARK)
        .groupBy(F.window("event_time", WINDOW, SLIDE), F.col("region"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count("sensor_id").alias("sensor_count"),
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.avg("humidity").alias("avg_humidity"),
        )
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "region",
        "sensor_count",
        "avg_temperature",
        "max_temperature",
        "min_temperature",
        "avg_humidity",
        "record_count",
    )


def run_aggregation(spark: SparkSession, bronze_dir: str, gold_dir: str, checkpoint: str):
    """K2 + T4: windowed aggregate appended once each window closes."""
    src = spark.readStream.schema(schemas.SENSOR_BRONZE).parquet(bronze_dir)
    q = (
        window_aggregate(src)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName("sensor_aggregation")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(gold_dir)
    )
    q.awaitTermination()
    return q
