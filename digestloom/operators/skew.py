"""Joins and orderings that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.session import materialise

# At most this many keys are treated as hot, so the broadcast list has a fixed bound.
MAX_HOT_KEYS = 1024
SALTS = 32


# Rows of a few short columns: some tens of megabytes on each executor.
MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a count shows that ``df`` is small.

    Beyond the limit the join stays a shuffled one. ``df`` should be cheap to count, that is
    already written down.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_keys(counts: DataFrame, key: str, n: str, at_most: int = MAX_HOT_KEYS) -> DataFrame:
    """The most frequent keys of a table of counts; bounded, hence safe to broadcast."""
    return counts.orderBy(F.desc(n), key).limit(at_most).select(key)


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: str,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join of many ``rows`` per key with few ``lookup`` rows per key.

    Rows of a hot key are spread over ``salts`` partitions and only the few lookup rows of
    those keys are copied to each. Which keys count as hot changes the speed, never the result.
    """
    marks = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    salt = F.when(
        F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    ).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    left = rows.join(marks, key, "left").withColumn("_salt", salt).drop("_hot")
    right = lookup.join(marks, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "rn", partitions: int | None = None
) -> DataFrame:
    """``row_number`` over the whole table without a one-partition window.

    Rows are range-partitioned on the full sort key, numbered inside their partition, and
    shifted by the sizes of the partitions before. ``order`` must be unique per row; then no
    key is hot, whatever the distribution. The placed rows are written once, so that the
    sizes and the numbers come from the same placement even when executors are lost; pass
    the columns that are needed, not whole documents.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "ranked",
    )
    # One row per partition: bounded by n.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.coalesce(
        F.sum("_size").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    starts = sizes.select("_part", before.alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at") + 1)
        .drop("_part", "_at", "_start")
    )


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rn") -> DataFrame:
    """First ``k`` rows per group. Spark limits each group before the shuffle as well as
    after it (the rank filter sits right on the window), so a hot group sends k rows per task."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def each(df: DataFrame, items: str, name: str, *keep: str) -> DataFrame:
    """One row per array item, with the ``keep`` columns.

    The outer form is used on purpose: for the inner one the optimiser adds a size filter
    below, which computes a derived array again.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())
