"""Calls of functions from outside whose failures are values, not the end of the job.

A tokenizer, parser or method that is plain Python may fail on one text of millions. A guarded
function runs on portions of Arrow batches; where a portion fails it is halved until the rows that fail stand
alone, so f failing rows of a portion of n cost about f * log2(n) more calls. Each row gets the
value or the error. A result of another type or number than promised is a failure, too; lack of
memory is not: it concerns the worker, and Spark tries the task again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

LONGEST_ERROR = 500
# Bytes of a batch that are Python objects at a time.
PORTION_BYTES = 1 << 20


def _attempt(function: Callable[..., Iterable], kind: pa.DataType, columns: list[pa.Array], n: int) -> tuple[list[pa.Array], list[str | None]]:
    """Values (in pieces) and errors of n rows."""
    try:
        values = list(function(*(c.to_pandas() for c in columns)))
        if len(values) != n:
            raise ValueError(f"{n} rows gave {len(values)} results")
        return [pa.array(values, type=kind)], [None] * n
    except MemoryError:
        raise
    except Exception as error:  # whatever a function from outside raises
        if n == 1:
            return [pa.nulls(1, kind)], [f"{type(error).__name__}: {error}"[:LONGEST_ERROR]]
    cut = n // 2
    first = _attempt(function, kind, [c[:cut] for c in columns], cut)
    second = _attempt(function, kind, [c[cut:] for c in columns], n - cut)
    return first[0] + second[0], first[1] + second[1]


def _portions(columns: Sequence[pa.Array]) -> list[tuple[int, int]]:
    """Ranges of rows with about ``PORTION_BYTES`` each, one empty range for no rows.

    Spark's batches count rows, whatever their size; as Python objects these take a multiple of it.
    """
    n = len(columns[0])
    rows = max(1, n * PORTION_BYTES // max(1, sum(c.nbytes for c in columns)))
    return [(at, min(at + rows, n)) for at in range(0, n, rows)] or [(0, 0)]


def _tried(function: Callable[..., Iterable], kind: pa.DataType, given: list[pa.Array]) -> pa.StructArray:
    """Value and error of each row; rows whose first column is null have neither."""
    there = given[0].is_valid()
    rows = [x.filter(there) for x in given]
    n = len(rows[0])
    parts, errors = _attempt(function, kind, rows, n) if n else ([pa.nulls(0, kind)], [])
    # Rows that were not tried take a null from beyond the end.
    at = pa.compute.if_else(there, pa.compute.subtract(pa.compute.cumulative_sum(there.cast(pa.int64())), 1), None)
    values = pa.concat_arrays(parts).take(at)
    return pa.StructArray.from_arrays([values, pa.array(errors, pa.string()).take(at)], names=["value", "error"])


class Guarded:
    """A function of pandas series, called so that failures of single rows stay single.

    Calling it with columns gives ``struct<value, error>``. Rows whose first column is null are
    not tried: both are null.
    """

    def __init__(self, function: Callable[..., Iterable], returns: str, name: str | None = None):
        self.function, self.returns = function, returns
        self.__name__ = name or getattr(function, "__name__", type(function).__name__)

    def __call__(self, *columns: Column) -> Column:
        from pyspark.sql.pandas.types import to_arrow_type

        function, kind = self.function, to_arrow_type(DataType.fromDDL(self.returns))

        def portions(batch: Sequence[pa.Array]) -> Iterator[pa.Array]:
            for start, end in _portions(batch):
                yield _tried(function, kind, [x[start:end] for x in batch])

        # Spark takes the results of a batch in pieces: none is held until the batch is done.
        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield from portions([batch])

        def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in batches:
                yield from portions(batch)

        call = F.arrow_udf(one if len(columns) == 1 else many, f"value {self.returns}, error string")
        # Spark must not write the call out twice, once for the value and once for the error.
        return call.asNondeterministic()(*columns)


def guarded(function: Callable[[pd.Series], Iterable], returns: str, name: str | None = None) -> Guarded:
    """Guard a function from series to series (or any iterable as long as them)."""
    return Guarded(function, returns, name)


def guarded_rows(function: Callable[..., Any], returns: str, name: str | None = None) -> Guarded:
    """Guard a function of single values."""

    def batch(*given: pd.Series) -> list:
        return [function(*row) for row in zip(*given)]

    return Guarded(batch, returns, name or getattr(function, "__name__", type(function).__name__))


def attempt(rows: DataFrame, name: str, function: Guarded, column: str, step: str, error_col: str = "error") -> DataFrame:
    """Add ``name``: the values of a guarded function of ``column``, null where it failed.

    ``error_col`` (added where it is missing) says which step failed and how. Rows that have an
    error already are not tried again and keep the first one.
    """
    if error_col not in rows.columns:
        rows = rows.withColumn(error_col, F.lit(None).cast("string"))
    tried = rows.withColumn("_attempt", function(F.when(F.col(error_col).isNull(), F.col(column))))
    failed = F.when(F.col("_attempt.error").isNotNull(), F.concat(F.lit(f"{step}: "), F.col("_attempt.error")))
    return tried.withColumns({name: F.col("_attempt.value"), error_col: F.coalesce(F.col(error_col), failed)}).drop("_attempt")
