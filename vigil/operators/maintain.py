"""Table lifecycle: DDL, row counts, retention, compaction, inspection
(K6, K8-K11, S12, O4).

Tables are parquet, partitioned by ``event_date`` and ``write_batch`` and
registered in the session catalog as external tables.  Every load and every
micro-batch is partitions of its own, written by dynamic partition overwrite,
so a repeated batch replaces itself; retention is a partition drop.

Compaction is a Spark rewrite of many small batches of a day into one new
batch.  The catalog then drops the old partitions of the day and adds the new
one: two commands, so a query planned between them misses that day's merged
rows, and one that reads the folder rather than the table sees them twice
until the old folders are gone.  It belongs where no reader runs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION = "event_date"
BATCH = "write_batch"

# Clustering columns of the monitoring tables (file sort order
# used by compaction, so min/max statistics prune by these columns).
CLUSTER_BY = {
    "streaming_metrics": ["event_type", "timestamp"],
    "stream_errors": ["query_name", "timestamp"],
    "data_quality_metrics": ["query_name", "timestamp"],
    "sla_latency_metrics": ["query_name", "sla_breach_flag", "timestamp"],
    "infrastructure_metrics": ["cluster_id", "timestamp"],
}


def _ddl_type(t) -> str:
    return t.simpleString()


def create_table(spark: SparkSession, name: str, schema: StructType, location: str, comment: str | None = None) -> None:
    """K6: CREATE TABLE ... USING parquet PARTITIONED BY (event_date,
    write_batch), NOT NULL columns as declared, with a table comment."""
    cols = ", ".join(f"`{f.name}` {_ddl_type(f.dataType)}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    cmt = f" COMMENT '{comment}'" if comment else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `{PARTITION}` date, `{BATCH}` string) USING parquet "
        f"PARTITIONED BY (`{PARTITION}`, `{BATCH}`) LOCATION '{location}'{cmt}"
    )


def append(df: DataFrame, name: str, ts: str = "timestamp") -> None:
    """Append rows to a registered table as one load, deriving the partition
    columns (columns are matched by name; extra columns are left out)."""
    insert_batch(df.withColumn(PARTITION, F.to_date(F.col(ts))), name, f"load-{uuid.uuid4().hex[:12]}")


def insert_batch(df: DataFrame, name: str, batch: str) -> None:
    """Rows with their ``event_date`` as the partitions of one batch of a
    catalog table (which registers them); a repeated batch replaces itself."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.withColumn(BATCH, F.lit(batch)).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def stream_batch(source: str, batch_id: int) -> str:
    """Batch name of a stream's micro-batch; names of one stream sort by id."""
    return f"{source}-{batch_id:012d}"


def write_batch(df: DataFrame, location: str, batch: str) -> None:
    """The same into a folder that no catalog table registers."""
    df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, BATCH).parquet(location)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """K8: table names of a database (catalog metadata, no data read).
    Session temporary views, which the catalog lists alongside, are left
    out."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; one job for all."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def retention_cutoff(as_of: dt.datetime | str, days: int) -> dt.date:
    t = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return t.date() - dt.timedelta(days=days)


def apply_retention(spark: SparkSession, name: str, as_of: dt.datetime | str, days: int) -> list[str]:
    """Drop every ``event_date`` partition older than the cutoff and
    delete its folder (an external table keeps the files of a dropped
    partition otherwise, and a later repair would bring them back).

    Only partition metadata is listed (one row per day); rows are never
    read or rewritten.  Returns the dropped partition values."""
    cutoff = retention_cutoff(as_of, days)
    parts = _partitions(spark, name)
    location = table_location(spark, name).rstrip("/")
    old = [p for p in parts if p[PARTITION] != "__HIVE_DEFAULT_PARTITION__" and dt.date.fromisoformat(p[PARTITION]) < cutoff]
    _drop_partitions(spark, name, old)
    dropped = sorted({p[PARTITION] for p in old})
    for value in dropped:
        _delete_path(spark, f"{location}/{PARTITION}={value}")
    return dropped


def _spec(part: Mapping[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"{k} = DATE'{v}'" if k == PARTITION else f"{k} = '{v}'" for k, v in part.items()) + ")"


def _drop_partitions(spark: SparkSession, name: str, parts: Sequence[Mapping[str, str]]) -> None:
    if parts:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_spec, parts))}")


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r[1] for r in rows if r[0] == "Location")


def _delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the cluster file system (HDFS, object
    stores, local), from the driver: a metadata-sized operation."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def _partitions(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """Partitions (column -> value) of a table, after registering partitions written
    straight into its folder (by streams).  A table whose folder does not
    exist yet has none."""
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    except Exception as e:  # folder not created yet: an empty table
        if "FileNotFoundException" not in str(e) and "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return [dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def retained(df: DataFrame, as_of: dt.datetime | str, days: int) -> DataFrame:
    """K10, read form: rows a retention run keeps (a partition filter, so
    older partitions are pruned at planning time)."""
    return df.filter(F.col(PARTITION) >= F.lit(retention_cutoff(as_of, days)))


TARGET_FILE_BYTES = 512 * 1024 * 1024


#: Bits per clustering column, and rows that place the boundaries.
CLUSTER_BITS = 5
BOUNDARY_ROWS = 4096


def cluster_key(rows: DataFrame, columns: Sequence[str], bits: int = CLUSTER_BITS) -> Column:
    """K9: a Z-order key over several columns: their quantile ranks (2^bits
    steps, nulls first), bits interleaved, first column highest.

    Boundaries come from a sample of at most ``BOUNDARY_ROWS`` rows (by hash,
    so any number of partitions gives the same); they place rows in files and
    change no result."""
    # a value of its own per row, so that repeated values keep their weight
    salt = F.xxhash64(*columns, F.monotonically_increasing_id())
    sample = rows.select(*columns).orderBy(salt).limit(BOUNDARY_ROWS).collect()
    ranks = []
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = sorted({values[len(values) * i >> bits] for i in range(1, 1 << bits)}) if values else []
        above = [(F.col(c) >= F.lit(x)).cast("int") for x in cuts]
        # few values are spread over all steps, so that their high bits differ
        rank = sum(above, F.lit(0)) * F.lit(1 << bits) / F.lit(len(cuts) + 1)
        ranks.append(F.coalesce(F.floor(rank).cast("int"), F.lit(0)))
    key = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)))
    return key


def files_touched(rows: DataFrame, column: str, values: Sequence) -> float:
    """Mean share of files whose range of ``column`` holds a value: what a
    filter on it reads by file statistics."""
    ranges = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    shares = [F.avg(((F.col("lo") <= F.lit(v)) & (F.col("hi") >= F.lit(v))).cast("double")) for v in values]
    return ranges.select((sum(shares, F.lit(0.0)) / len(values)).alias("share")).first()[0]


def _file_sizes(spark: SparkSession, location: str) -> dict[tuple[str, str], list[int]]:
    """Bytes of the files of each (day, batch), from file-system metadata."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{location}/{PARTITION}=*/{BATCH}=*/[!_.]*")
    out: dict[tuple[str, str], list[int]] = {}
    for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []:
        folder = f.getPath().getParent()
        key = (folder.getParent().getName().split("=", 1)[1], folder.getName().split("=", 1)[1])
        out.setdefault(key, []).append(f.getLen())
    return out


def _mergeable(batches: Sequence[str]) -> set[str]:
    """Batches a merge may take: all but the newest of each stream, which a
    restart may write again."""
    newest: dict[str, str] = {}
    for b in batches:
        source, number = b.rsplit("-", 1)
        if source not in ("load", "merge"):
            newest[source] = max(newest.get(source, b), b)
    return set(batches) - set(newest.values())


def compact(spark: SparkSession, name: str, sort_cols: list[str], target_file_bytes: int = TARGET_FILE_BYTES, layout: str = "linear") -> list[str]:
    """K9: rewrite the days whose mergeable batches have more files than their
    size asks for into one new batch each; returns those days.

    Rows are range partitioned by (event_date, sort columns), or with
    ``layout="z"`` by (event_date, Z-order key of the sort columns), so one
    busy day is written by several tasks and file statistics prune.  What the
    merge replaces is written down first: a run that is cut off leaves either
    an unused new batch or old partitions that the next run drops.  Tables
    without a ``write_batch`` column are left as they are."""
    if BATCH not in spark.table(name).columns or not _partitions(spark, name):
        return []
    location = table_location(spark, name).rstrip("/")
    _finish_merges(spark, name, location)
    sizes = _file_sizes(spark, location)
    free = _mergeable([b for _, b in sizes])
    by_day: dict[str, list[tuple[str, list[int]]]] = {}
    for (day, batch), files in sizes.items():
        if batch in free:
            by_day.setdefault(day, []).append((batch, files))
    wanted = {d: max(1, -(-sum(sum(f) for _, f in bs) // target_file_bytes)) for d, bs in by_day.items()}
    due = sorted(d for d, bs in by_day.items() if sum(len(f) for _, f in bs) > wanted[d])
    if not due:
        return []
    replaced = sorted((d, b) for d in due for b, _ in by_day[d])
    run = "merge-" + hashlib.sha1(repr(replaced).encode()).hexdigest()[:12]
    spark.createDataFrame([(run, d, b) for d, b in replaced], "run string, day string, batch string").write.mode("overwrite").parquet(f"{location}/_merges/{run}")
    rows = spark.read.schema(spark.table(name).schema).option("basePath", location).parquet(*[f"{location}/{PARTITION}={d}/{BATCH}={b}" for d, b in replaced]).drop(BATCH)
    order = [F.col(c) for c in sort_cols]
    if layout == "z":
        rows = rows.withColumn("_z", cluster_key(rows, sort_cols))
        order = [F.col("_z"), *order]
    rows = rows.repartitionByRange(sum(wanted[d] for d in due), PARTITION, *order).sortWithinPartitions(PARTITION, *order).drop("_z")
    write_batch(rows, location, run)
    _finish_merges(spark, name, location)
    return due


def _finish_merges(spark: SparkSession, name: str, location: str) -> None:
    """Put finished merges in the place of what they replaced, then delete it."""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{location}/_merges")
    fs = log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(log):
        return
    merges: dict[tuple[str, str], list[str]] = {}
    for r in spark.read.schema("run string, day string, batch string").parquet(f"{location}/_merges/*").collect():  # one row per replaced partition
        merges.setdefault((r["run"], r["day"]), []).append(r["batch"])
    for (run, day), batches in merges.items():
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{location}/{PARTITION}={day}/{BATCH}={run}")):
            _drop_partitions(spark, name, [{PARTITION: day, BATCH: b} for b in batches])
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_spec({PARTITION: day, BATCH: run})}")
            for b in batches:
                _delete_path(spark, f"{location}/{PARTITION}={day}/{BATCH}={b}")
    fs.delete(log, True)
    spark.catalog.refreshTable(name)


def latest(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Newest ``n`` rows (a top-k: each task keeps its own n rows)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def create_monitoring_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """K6 / K7: the database and every monitoring table (bronze, five silver,
    sensor bronze and gold) as external parquet tables partitioned by day and
    batch."""
    from vigil import schemas

    tables = {
        "raw_events": (schemas.EVENT_LOG_READ, "Raw streaming events (bronze event log)"),
        "streaming_metrics": (schemas.STREAMING_METRICS, "Per-micro-batch streaming metrics in event-log format"),
        "stream_errors": (schemas.STREAM_ERRORS, "Stream error and termination events"),
        "data_quality_metrics": (schemas.DATA_QUALITY_METRICS, "Per-batch data quality"),
        "sla_latency_metrics": (schemas.SLA_LATENCY_METRICS, "Per-batch latency and SLA breach flag"),
        "infrastructure_metrics": (schemas.INFRASTRUCTURE_METRICS, "Cluster infrastructure metrics"),
        "sensor_bronze": (schemas.SENSOR_BRONZE, "Sensor readings (bronze)"),
        "sensor_gold": (schemas.SENSOR_GOLD, "Sensor sliding-window aggregates (gold)"),
    }
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for name, (schema, comment) in tables.items():
        create_table(spark, f"{database}.{name}", schema, f"{root}/{name}", comment)
    return [f"{database}.{n}" for n in tables]
