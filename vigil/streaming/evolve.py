"""Ingest of JSON whose schema changes.

Every landed line is parsed once into a VARIANT, so no drop can fail the
stream or lose a field: declared columns are read from it with ``try`` casts,
and what does not fit the declaration (new fields, values of another type) is
kept as JSON in ``rescued``; a line that is no JSON object at all is kept whole
in ``corrupt``.  Each micro-batch also writes the paths and types it saw to a
schema log, from which ``schema_changes`` reads new fields and new types at
any depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: How a value is named in the schema log: JSON has one kind of number.
JSON_TYPES = {"BIGINT": "NUMBER", "DECIMAL": "NUMBER", "DOUBLE": "NUMBER", "FLOAT": "NUMBER", "VOID": "NULL"}


def landed_lines(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing zone as a stream of parsed lines: ``line``, ``payload``
    (VARIANT; null for what is no JSON object)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    parsed = r.load(landing_dir).select(F.col("value").alias("line"), F.try_parse_json("value").alias("payload"))
    # what parses and begins with a brace is an object; only the rest is asked for its schema
    is_object = F.col("line").startswith("{") | (_head(F.col("payload")) == "OBJECT")
    return parsed.withColumn("payload", F.when(is_object, F.col("payload")))


def _head(value: Column) -> Column:
    """Outermost type of a variant value as Spark names it."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def _json_type(head: Column) -> Column:
    return reduce(lambda e, kv: e.when(head == kv[0], kv[1]), JSON_TYPES.items(), F.when(head.isNull(), F.lit(None))).otherwise(head)


def typed(lines: DataFrame, declared: StructType) -> DataFrame:
    """Declared columns, ``rescued`` (JSON of the fields that are not declared
    or do not fit, null if none) and ``corrupt``.

    A value that converts (the text "7.5" in a number column) is taken; of a
    line with a repeated field the parser makes a corrupt line."""
    fields = F.try_variant_get("payload", "$", "map<string,variant>")

    def unfit(name: Column, value: Column) -> Column:
        keep = F.lit(True)
        for f in declared.fields:
            lost = F.try_variant_get(value, "$", f.dataType.simpleString()).isNull() & ~F.is_variant_null(value)
            keep = F.when(name == f.name, lost).otherwise(keep)
        return keep

    # a column of its own, as it is read twice
    rows = lines.select("line", "payload", F.map_filter(fields, unfit).alias("rest"))
    return rows.select(
        *[F.try_variant_get("payload", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in declared.fields],
        F.when(F.size("rest") > 0, F.to_json("rest")).alias("rescued"),
        F.when(F.col("payload").isNull(), F.col("line")).alias("corrupt"),
    )


def _levels(payloads: DataFrame, depth: int) -> DataFrame:
    """Counts by ``path1``, ``later1``, ``type1`` .. to ``depth``: objects
    opened level by level in one pass over ``payloads`` (column ``v``), counted
    per task before the shuffle.  ``later`` is true for the fields of an object
    after its first."""
    spark, kept, rows = payloads.sparkSession, [], payloads.select(F.lit("$").alias("path"), F.col("v").alias("open"))
    for k in range(1, depth + 1):
        inner = ", ".join(["path", *kept, "e.pos", "e.key", "e.value"])
        rows = spark.sql(f"SELECT {inner} FROM {{rows}}, LATERAL variant_explode_outer(open) AS e(pos, key, value)", rows=rows)
        rows = rows.select(*kept, F.concat("path", F.lit("."), "key").alias(f"path{k}"), F.coalesce(F.col("pos") > 0, F.lit(False)).alias(f"later{k}"), _head(F.col("value")).alias(f"type{k}"), "value")
        kept += [f"path{k}", f"later{k}", f"type{k}"]
        rows = rows.select(*kept, F.col(f"path{k}").alias("path"), F.when(F.col(f"type{k}") == "OBJECT", F.col("value")).alias("open"))
    return rows.groupBy(*kept).agg(F.count(F.lit(1)).alias("n"))


def batch_schema(lines: DataFrame, depth: int = 2) -> DataFrame:
    """``path``, ``type``, ``row_count`` of every field of a micro-batch.

    ``depth`` levels are read in one pass; if objects remain below them, a
    pass of twice as many levels follows.  Arrays are not entered."""
    payloads = lines.filter(F.col("payload").isNotNull()).select(F.col("payload").alias("v"))
    while True:
        counts = _levels(payloads, depth).persist()  # a few rows per path
        if counts.filter(F.col(f"type{depth}") == "OBJECT").isEmpty():
            break
        counts.unpersist()
        depth *= 2
    # a field is repeated in the rows of all fields inside it: count it at the first of them
    inside = lambda k: reduce(lambda x, j: x & ~F.col(f"later{j}"), range(k + 1, depth + 1), F.lit(True))
    fields = [F.when(inside(k), F.struct(F.lit(k).alias("level"), F.col(f"path{k}").alias("path"), _json_type(F.col(f"type{k}")).alias("type"))) for k in range(1, depth + 1)]
    seen = counts.select("n", F.explode(F.array(*fields)).alias("f")).filter(F.col("f.path").isNotNull())
    return seen.groupBy("f.level", "f.path", "f.type").agg(F.sum("n").alias("row_count")).select("path", "type", "row_count")


def run_evolving_ingest(spark: SparkSession, landing_dir: str, out_dir: str, log_dir: str, checkpoint: str, declared: StructType):
    """K1: drain the landing zone.  Rows and schema log of a micro-batch go
    into its own ``batch_id=N`` folder, which a repeated batch overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        typed(batch, declared).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        batch_schema(batch).coalesce(1).write.mode("overwrite").parquet(f"{log_dir}/batch_id={batch_id}")

    q = landed_lines(spark, landing_dir).writeStream.foreachBatch(write).queryName("evolving_ingest").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def schema_changes(log: DataFrame) -> DataFrame:
    """U5 with types and nested paths: each (batch, path, type) of the schema
    log and what it means against all earlier batches: INITIAL (first batch of
    the log), NEW FIELD, NEW TYPE or KNOWN.  The log has a few rows per batch."""
    begin = log.agg(F.min("batch_id")).first()[0]
    first_path = log.groupBy("path").agg(F.min("batch_id").alias("_first_path"))
    first_type = log.groupBy("path", "type").agg(F.min("batch_id").alias("_first_type"))
    b = F.col("batch_id")
    change = (
        F.when(b == F.lit(begin), "INITIAL").when(b == F.col("_first_path"), "NEW FIELD").when(b == F.col("_first_type"), "NEW TYPE").otherwise("KNOWN")
    )
    j = log.join(first_path, "path").join(first_type, ["path", "type"])
    return j.select("batch_id", "path", "type", "row_count", change.alias("change"))
