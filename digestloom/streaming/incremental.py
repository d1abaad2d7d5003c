"""The run-to-run behaviour of the daily job, as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from digestloom.functions.dates import utc_day
from digestloom.operators.processed import unprocessed_few
from digestloom.session import materialise, scratch_released
from digestloom.sources.state import append_state, read_state


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """Stream of the parquet files below ``path``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def batch_id_text(stream_id: str, batch_id: int) -> str:
    return f"{stream_id}-{batch_id:012d}"


def stream_identity(spark: SparkSession, checkpoint_dir: str) -> str:
    """Identity of the stream of a checkpoint folder: kept over restarts, new with a new folder."""
    return spark.read.schema("id STRING").json(f"{checkpoint_dir}/metadata").first()["id"]


def incremental_ingest(
    stream: DataFrame,
    out_dir: str,
    state_dir: str,
    checkpoint_dir: str,
    as_of,
    keep: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    first: tuple[str, ...] = ("published_ts",),
) -> StreamingQuery:
    """Process what is new since the last run, each id once, for ever.

    Per batch: rows that ``keep`` keeps, the first row of each id (by ``first``), minus the
    processed ids; the output is written before the state. Folders are named by the stream
    (its checkpoint) and the batch. A batch that is replayed leaves its own state out and
    replaces its own folders, so nothing doubles; another stream, or one with a new checkpoint,
    has names of its own, so nothing that was written is lost. Rows with an unknown time take
    the same path: no watermark drops them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_released(batch.sparkSession):
            write_batch(batch, batch_id)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = batch_id_text(stream_identity(spark, checkpoint_dir), batch_id)
        batch = keep(batch)
        columns = [c for c in batch.columns if c != "article_id"]
        row = F.struct(*first, *[c for c in columns if c not in first])
        once = materialise(
            batch.groupBy("article_id").agg(F.min(row).alias("r")).select("article_id", "r.*"),
            "batch",
        )
        state = read_state(spark, state_dir, except_run=run_id, ids=once)
        unprocessed_few(once, state).write.mode("overwrite").parquet(f"{out_dir}/run_id={run_id}")
        written = spark.read.parquet(f"{out_dir}/run_id={run_id}")
        append_state(written, state_dir, run_id, as_of)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def bounded_dedup(stream: DataFrame, ts: str = "published_ts", delay: str = "7 days") -> DataFrame:
    """Each id once as long as its copies come within ``delay``; the state stays bounded."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["article_id"])


def daily_counts(stream: DataFrame, ts: str = "published_ts", delay: str = "7 days") -> DataFrame:
    """Entries per day; a day is final once the stream is ``delay`` past its end.

    ``ts`` is a wall-clock time turned into an instant by ``dates.as_event_time``. Rows without
    a time belong to no day and come out of ``undated`` instead.
    """
    return (
        stream.filter(F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(F.count("*").alias("n_entries"))
        .select(F.expr(utc_day("w.start")).alias("post_date"), "n_entries")
    )


def undated(stream: DataFrame, ts: str = "published_ts") -> DataFrame:
    """Rows whose time is unknown, which no watermark may drop: the side table of the counts."""
    return stream.filter(F.col(ts).isNull())


def append_to(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Write an append-mode stream of everything available to parquet."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
