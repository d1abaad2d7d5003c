"""Columns of the caller that are named like an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame

PREFIX = "_dl_"


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it while it is taken."""
    while name in taken:
        name += "_"
    return name


def set_aside(documents: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with such columns renamed, and their names: ``{new: old}``."""
    taken, back = list(documents.columns), {}
    for old in documents.columns:
        if old.startswith(PREFIX):
            new = free("own" + old, taken)
            taken.append(new)
            back[new] = old
    return documents.withColumnsRenamed({old: new for new, old in back.items()}), back


def renamed(name: str, back: dict[str, str]) -> str:
    """Where a column of the caller is meanwhile."""
    return next((new for new, old in back.items() if old == name), name)
