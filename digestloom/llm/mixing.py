"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a budget of words: its weight's part of the whole mix, at most ``max_epochs``
times its size; what is above is shared again by weight until no source is above. A source
gives complete epochs first. The rest of its budget goes to documents in the order of
exponential keys ``-ln(u) / quality``: a document of twice the quality comes early twice as
likely. Sizes are summed along that order and documents are taken whole up to the budget; the
document that crosses it is taken if that ends nearer to the budget.

A source may hold any part of all rows: keys are sorted in range partitions over (source, key),
summed inside each partition, and shifted by the sums of the partitions before. Only sums per
partition and source meet; no source is one task. Budgets come from rounds over the table of
sources, each of which gives the driver one row of sums.

Edge cases: a null text has size 0; a null source is a source of its own and comes last; a null
id draws like an empty one; rows that repeat an id are documents of their own with the same key;
a quality that is null, not finite or not positive counts as 1; other columns are not read; an
empty table gives an empty result. ``u`` is made of the id and the seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.llm import plain_words
from digestloom.operators.skew import broadcast_if_small, global_row_number
from digestloom.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def _sized(batches):
    """The number of words in place of the text, which is the last column."""
    for batch in batches:
        sizes = pa.array([plain_words.n_words(data) for data in plain_words.texts(batch.column("text"))], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*batch.schema.names[:-1], "size"])


def uniform(doc_id: str | Column, seed: str = SEED) -> Column:
    """A fixed number in (0, 1) for each id: the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _quality(column: Column) -> Column:
    sound = (column > 0) & (column < float("inf")) & ~F.isnan(column)
    return F.when(F.coalesce(sound, F.lit(False)), column).otherwise(F.lit(1.0))


def budgets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_no, source_size, target`` of a written table ``source, source_size``."""
    ordered = global_row_number(sizes, [F.col("source").isNull(), F.col("source")], "source_no")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialise(ordered.withColumn("weight", weight), "sources")
    most = F.lit(float(max_epochs)) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, open_weight, capped = share * total, None, -1
    while True:
        target = most if open_weight is None else F.col("weight") * F.lit(left) / F.lit(open_weight)
        above = F.lit(False) if open_weight is None else target > most
        n, taken, rest = sources.agg(
            F.count_if(above), F.sum(F.when(above, most).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        if n == capped or not rest:
            break
        # A source that is above stays above: what it leaves only raises the others.
        capped, left, open_weight = (-1 if open_weight is None else n), share * total - taken, rest
    target = F.least(target, most) if open_weight is not None else most
    return sources.select("source", "source_no", "source_size", target.alias("target"))


def _summed(batches):
    """Words of the source before each row, within a sorted partition."""
    source, carried = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers, sizes = (batch.column(c).to_numpy() for c in ("source_no", "size"))
        sums = np.cumsum(sizes)
        begins = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
        base = sums[begins] - sizes[begins]
        if numbers[0] == source:
            base[0] -= carried
        before = sums - sizes - np.repeat(base, np.diff(np.append(begins, len(numbers))))
        source, carried = int(numbers[-1]), int(before[-1] + sizes[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])


def mix(
    docs: DataFrame,
    *,
    quality: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies``: words and copies the mix takes."""
    weight = F.lit(1.0) if quality is None else _quality(quality.cast("double"))
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), (-F.log(uniform(id_col, seed)) / weight).alias("key"),
        F.col(text_col).alias("text"),
    )
    rows = materialise(keyed.mapInArrow(_sized, f"doc_id {id_type}, source string, key double, size long"), "sizes")
    sizes = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    sources = materialise(budgets(sizes, weights, share, max_epochs), "budgets")
    # Rows that agree in all columns are told apart, so that range partitions can part them.
    order = ["source_no", "key", "doc_id", "size", "tie"]
    numbered = rows.withColumn("tie", F.monotonically_increasing_id()).join(
        broadcast_if_small(sources.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        numbered.select(*order)
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("doc_id", "size", "source_no", "part")
        .mapInArrow(_summed, f"doc_id {id_type}, size long, source_no long, part int, before long"),
        "summed",
    )
    # A partition is a range: there are at most as many of these rows as partitions and sources.
    parts = placed.groupBy("source_no", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(parts.select("source_no", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")), "starts")
    ends = starts.join(sources.drop("source"), "source_no")
    before, size = F.col("start") + F.col("before"), F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # Whole below the budget, or nearer to it than without the document.
    drawn = (F.col("rest") > before) & (2 * (F.col("rest") - before) > size)
    return (
        placed.join(broadcast_if_small(ends.withColumn("epochs", epochs).withColumn("rest", rest)), ["source_no", "part"])
        .withColumn("copies", F.col("epochs") + drawn.cast("long"))
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * size).alias("taken"), "copies")
    )


def repeated(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: each document as often as ``mix`` takes it. Ids have to be unique."""
    plan = plan.filter("copies > 0").select(F.col("doc_id").alias("_mix_id"), F.col("copies").alias("_mix_copies"))
    joined = docs.join(plan, F.col(id_col) == F.col("_mix_id"))
    times = F.expr("explode(sequence(1L, _mix_copies))").alias("_mix_epoch")
    return joined.select(*docs.columns, times).drop("_mix_epoch")
