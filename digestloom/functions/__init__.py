"""SQL expressions. Each function takes SQL expressions as text and returns one.

Everything here is row-local: no shuffle, no Python worker. Text is used instead of column
objects because a deep expression costs the driver one parse instead of thousands of calls;
wrap the result in ``pyspark.sql.functions.expr`` to get a column.
"""
