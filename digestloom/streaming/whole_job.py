"""The daily job as a stream: listing items wait for their page and come out once.

Listing and pages are two streams. An item waits in the state of an outer join until its page
lands, at most ``wait`` after it was listed; then it comes out without one, as missing. Watermarks
bound the state on both sides: a page waits as long for its item. Each batch is a run of its own:
ids that the store knows are left out, the rest is parsed, summarised and committed with its
state in one step, under the name of the stream and the batch, so a replayed batch replaces what
it wrote before.

Edge cases: an item listed again within ``delay`` counts once; a page that lands twice in one
batch counts with its latest version, and in a later batch not at all; items and pages without a
time, and those later than the watermark, take no part (``undated`` is their side table); a page
that lands after its item came out as missing stays unposted until the item is listed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from digestloom.operators.processed import unprocessed_few
from digestloom.plans.daily_run import Options, process_new
from digestloom.session import materialise, scratch_released
from digestloom.sources.store import Store
from digestloom.streaming.incremental import batch_id_text, stream_identity

WAIT = "2 days"
DELAY = "1 hour"


def awaited(listing: DataFrame, pages: DataFrame, wait: str = WAIT, delay: str = DELAY) -> DataFrame:
    """Items ``article_id, listed_at, page, pos`` with ``html, landed_at`` of their page, or null once the wait is over.

    ``listing`` has a time ``listed_at`` and ``pages`` a time ``landed_at``.
    """
    items = listing.select("article_id", "listed_at", "page", "pos").filter("listed_at IS NOT NULL AND article_id IS NOT NULL")
    items = items.withWatermark("listed_at", delay).dropDuplicatesWithinWatermark(["article_id"])
    landed = pages.select(F.col("article_id").alias("page_of"), "html", "landed_at").filter("landed_at IS NOT NULL")
    landed = landed.withWatermark("landed_at", delay)
    in_time = F.expr(f"article_id = page_of AND landed_at >= listed_at - INTERVAL {wait} AND landed_at <= listed_at + INTERVAL {wait}")
    return items.join(landed, in_time, "left_outer")


def run_as_stream(
    listing: DataFrame,
    pages: DataFrame,
    store: Store,
    missing_dir: str,
    checkpoint_dir: str,
    as_of,
    options: Options = Options(),
    wait: str = WAIT,
    delay: str = DELAY,
) -> StreamingQuery:
    """Post what is there, keep the rest waiting, and write ``article_id, listed_at`` of items that waited too long."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = batch_id_text(stream_identity(spark, checkpoint_dir), batch_id)
        with scratch_released(spark):
            rows = materialise(batch, "batch")
            late = rows.filter("page_of IS NULL").select("article_id", "listed_at")
            late.write.mode("overwrite").parquet(f"{missing_dir}/run_id={run_id}")
            began = store.version()
            place = F.min(F.struct("page", "pos")).alias("at")
            ids = materialise(rows.filter("page_of IS NOT NULL").groupBy("article_id").agg(place).select("article_id", "at.*"), "ids")
            new_ids = materialise(unprocessed_few(ids, store.state(run_id, ids, began)), "new-ids")
            if not new_ids.isEmpty():
                landed = rows.filter("page_of IS NOT NULL").select("article_id", "html", "landed_at")
                store.write_run(process_new(new_ids, landed, as_of, options)[1], run_id, as_of, began)

    return (
        awaited(listing, pages, wait, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
