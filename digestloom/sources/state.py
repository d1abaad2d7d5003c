"""The table of processed ids, and its JSON form."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions.dates import run_stamp, wall_time
from digestloom.session import path_exists

STATE_SCHEMA = "article_id STRING, processed_at STRING"
STORED_SCHEMA = STATE_SCHEMA + ", run_id STRING, id_day STRING"

# Ids per exported JSON document, so that no document grows with the state.
IDS_PER_DOCUMENT = 10_000


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


# Days of ids that one read names; a read of more days takes them all.
MAX_DAYS = 1000


def id_day(article_id: str = "article_id") -> F.Column:
    """Day part of an id, by which the state is partitioned; ids of another form share one."""
    return F.when(F.col(article_id).rlike("^[0-9]{14}$"), F.substring(article_id, 1, 8)).otherwise("other")


def read_state(spark: SparkSession, path: str, except_run: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Processed ids of all committed runs but ``except_run``; a missing folder is an empty state.

    With ``ids`` only the days that these have are read. A run leaves out what it wrote itself
    in an earlier try; every other run counts, also a later one, so a backfill sees all.
    """
    if not path_exists(spark, path):
        return empty_state(spark)
    table = spark.read.schema(STORED_SCHEMA).parquet(path)
    if except_run is not None:
        table = table.filter(F.col("run_id") != except_run)
    return of_days(table, ids).select("article_id", "processed_at")


def of_days(table: DataFrame, ids: DataFrame | None) -> DataFrame:
    """The part of a stored state that has the days of ``ids``; all of it without them."""
    if ids is None:
        return table
    days = [r[0] for r in ids.select(id_day()).distinct().limit(MAX_DAYS + 1).collect()]
    return table.filter(F.col("id_day").isin(days)) if len(days) <= MAX_DAYS else table


def compact_state(spark: SparkSession, path: str, into: str) -> None:
    """Write the state of all runs into the new folder ``into``: few files per day of ids.

    Each id keeps the time it was processed first. Readers change over to the new folder.
    """
    write_compacted(read_state(spark, path), f"{into}/run_id=compacted")


def write_compacted(state: DataFrame, folder: str) -> None:
    table = state.groupBy("article_id").agg(F.min("processed_at").alias("processed_at"))
    by_day = table.withColumn("id_day", id_day()).repartition("id_day", F.pmod(F.xxhash64("article_id"), F.lit(4)))
    by_day.write.mode("errorifexists").partitionBy("id_day").parquet(folder)


def append_state(ids: DataFrame, path: str, run_id: str, as_of: datetime | str) -> None:
    """Add the ids of one run. A repeated run replaces its own folder, so nothing doubles."""
    (
        ids.select("article_id")
        .distinct()
        .withColumn("processed_at", F.expr(run_stamp(wall_time(as_of))))
        .withColumn("id_day", id_day())
        .write.mode("overwrite")
        .partitionBy("id_day")
        .parquet(f"{path}/run_id={run_id}")
    )


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document. The id list is read as its own JSON text, so that a value of
    another kind is no error; ``broken`` holds the text of what is not JSON."""
    schema = "processed_ids STRING, last_run_at STRING, broken STRING"
    reader = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "broken")
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("file"))


def read_state_json(spark: SparkSession, path: str) -> DataFrame:
    """Ids from JSON state documents ``{"processed_ids": [...], "last_run_at": ...}``.

    A missing path, a broken document, and a document without an id list all count as empty.
    """
    if not path_exists(spark, path):
        return empty_state(spark)
    ids = F.from_json("processed_ids", "array<string>")
    return _documents(spark, path).filter("broken IS NULL").select(
        F.explode(ids).alias("article_id"), F.col("last_run_at").alias("processed_at")
    )


def corrupt_state_json(spark: SparkSession, path: str, as_of: datetime | str) -> DataFrame:
    """State documents that are not JSON, under the name of their quarantine copy."""
    stamp = F.date_format(F.expr(wall_time(as_of)), "yyyyMMddHHmmss")
    return (
        _documents(spark, path)
        # A reader may not be asked for the broken text alone.
        .filter(F.col("broken").isNotNull() & F.col("processed_ids").isNull())
        .select(
            F.concat(F.col("file"), F.lit(".corrupt."), stamp).alias("quarantine"),
            F.col("broken").alias("value"),
        )
    )


def quarantine_state_json(spark: SparkSession, path: str, folder: str, as_of: datetime | str) -> int:
    """Copy broken state documents to ``folder`` (name and text) and return their number.

    The run goes on with the sound ones; a caller that wants to stop looks at the number.
    """
    if not path_exists(spark, path):
        return 0
    corrupt_state_json(spark, path, as_of).write.mode("append").json(folder)
    names = spark.read.schema("quarantine STRING, value STRING").json(folder)
    stamp = F.date_format(F.expr(wall_time(as_of)), "yyyyMMddHHmmss")
    return names.filter(F.endswith("quarantine", F.concat(F.lit(".corrupt."), stamp))).select("quarantine").distinct().count()


def export_state_json(state: DataFrame, path: str, as_of: datetime | str,
                      documents: int | None = None) -> None:
    """Write the state as JSON documents, one per file, of a bounded number of ids.

    Ids go to documents by hash, so each one stays near ``IDS_PER_DOCUMENT`` entries.
    """
    ids = state.select("article_id").distinct()
    if documents is None:
        documents = max(1, -(-ids.count() // IDS_PER_DOCUMENT))
    shard = F.pmod(F.xxhash64("article_id"), F.lit(documents))
    (
        ids.groupBy(shard.alias("shard"))
        .agg(F.sort_array(F.collect_list("article_id")).alias("processed_ids"))
        .select("shard", "processed_ids", F.expr(run_stamp(wall_time(as_of))).alias("last_run_at"))
        .write.mode("overwrite")
        .partitionBy("shard")
        .json(path)
    )
