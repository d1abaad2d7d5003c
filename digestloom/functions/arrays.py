"""Small helpers to write array expressions."""

from __future__ import annotations

import inspect
import itertools
from collections.abc import Callable

_fresh = itertools.count()


def lit(text: str) -> str:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    for char, code in (("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r"), ("\x01", "\\u0001")):
        escaped = escaped.replace(char, code)
    return f"'{escaped}'"


def _lambda(body: Callable[..., str]) -> str:
    names = [f"v{next(_fresh)}" for _ in inspect.signature(body).parameters]
    head = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{head} -> {body(*names)}"


def transform(values: str, body: Callable[..., str]) -> str:
    """``body`` takes the element, and the index if it has a second parameter."""
    return f"transform({values}, {_lambda(body)})"


def keep(values: str, body: Callable[..., str]) -> str:
    return f"filter({values}, {_lambda(body)})"


def zip_with(a: str, b: str, body: Callable[[str, str], str]) -> str:
    return f"zip_with({a}, {b}, {_lambda(body)})"


def fold(values: str, start: str, body: Callable[[str, str], str], finish: Callable[[str], str] = lambda a: a) -> str:
    return f"aggregate({values}, {start}, {_lambda(body)}, {_lambda(finish)})"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A lambda argument is a value, not an expression, so a costly ``value`` is not
    repeated for every element when ``body`` refers to it inside another lambda.
    """
    return f"element_at({transform(f'array({value})', body)}, 1)"


def runs(values: str, same: Callable[[str, str], str]) -> str:
    """Runs of equal neighbours in a sorted array, as ``array<struct<lo,hi>>`` (0-based, half open)."""

    def body(vs: str) -> str:
        def start(v: str, i: str) -> str:
            return f"CASE WHEN {i} = 0 OR NOT ({same(f'get({vs}, {i} - 1)', v)}) THEN {i} END"

        starts = keep(transform(vs, start), lambda i: f"{i} IS NOT NULL")
        return let(
            starts,
            lambda st: transform(
                st, lambda lo, k: struct(lo=lo, hi=f"coalesce(get({st}, {k} + 1), size({vs}))")
            ),
        )

    return let(values, body)


def total(values: str, term: Callable[[str], str] = lambda v: v) -> str:
    """Sum of ``term`` over a double array, left to right."""
    return fold(values, "0D", lambda acc, v: f"{acc} + {term(v)}")


def blank_to_null(text: str) -> str:
    """Null for an empty string (``nullif`` would evaluate a costly ``text`` twice)."""
    return let(text, lambda t: f"CASE WHEN {t} <> '' THEN {t} END")
