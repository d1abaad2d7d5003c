"""Whitespace, tokens, sentences and words."""

from __future__ import annotations

from collections.abc import Iterable

from digestloom.functions.arrays import keep, let, lit, runs, struct, transform

# Whitespace as Unicode-aware string functions see it (for a regex class).
WHITESPACE = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}"

# Function words that never become keywords.
STOPWORDS = (
    "것", "등", "수", "이", "그", "저", "때", "년", "월", "일", "위", "중", "및",
    "관련", "통해", "대한", "기자", "오늘", "지난해", "올해", "현재", "이번", "이날",
    "우리", "자신", "때문", "이후", "이상", "정도", "가운데", "그리고",
)

TOKEN = r"([\p{L}\p{N}]+)"


def strip(text: str) -> str:
    """Remove leading and trailing whitespace of every kind (``trim`` removes spaces only)."""
    pattern = rf"^[{WHITESPACE}]+|[{WHITESPACE}]+$"
    return f"regexp_replace({text}, {lit(pattern)}, '')"


def is_blank(text: str) -> str:
    return f"({text} IS NULL OR {strip(text)} = '')"


def raw_tokens(text: str) -> str:
    """Lower-cased runs of letters and digits."""
    return f"regexp_extract_all(lower(coalesce({text}, '')), {lit(TOKEN)}, 1)"


def keep_tokens(tokens: str, stopwords: Iterable[str] = STOPWORDS) -> str:
    """Drop one-character tokens and stopwords."""
    stop = ", ".join(map(lit, stopwords))
    listed = (lambda t: f" AND {t} NOT IN ({stop})") if stop else (lambda t: "")
    return keep(tokens, lambda t: f"length({t}) > 1{listed(t)}")


def content_tokens(text: str) -> str:
    """Tokens that may become keywords."""
    return keep_tokens(raw_tokens(text))


def sentences(text: str, split_newlines: bool = False) -> str:
    """Sentences end at whitespace after ``.``, ``!`` or ``?``; blank ones are dropped."""
    cut = rf"(?<=[.!?])[{WHITESPACE}]+"
    if split_newlines:
        cut += r"|[\r\n]+"
    parts = f"split(coalesce({text}, ''), {lit(cut)})"
    return keep(transform(parts, strip), lambda s: f"{s} <> ''")


def words(sentence: str) -> str:
    """Whitespace-separated words of one sentence."""
    return keep(f"split({sentence}, {lit(f'[{WHITESPACE}]+')})", lambda w: f"{w} <> ''")


def term_counts(tokens: str) -> str:
    """Count each token of the row: ``array<struct<term,tf_count,first_pos>>``, in term order.

    Sorting the row's own tokens and measuring the runs replaces a shuffle on
    (document, term): the tokens of a document never leave its task.
    """
    placed = f"sort_array({transform(tokens, lambda t, i: struct(term=t, pos=i))})"
    return let(
        placed,
        lambda ts: transform(
            runs(ts, lambda a, b: f"{a}.term = {b}.term"),
            lambda r: struct(
                term=f"get({ts}, {r}.lo).term",
                tf_count=f"bigint({r}.hi - {r}.lo)",
                first_pos=f"get({ts}, {r}.lo).pos",
            ),
        ),
    )


def reading_minutes(text: str, words_per_minute: int = 200) -> str:
    """Whole minutes needed to read ``text``, at least one."""
    n = f"size({words(f'''coalesce({text}, '')''')})"
    return f"bigint(greatest(1, ceil({n} / {int(words_per_minute)})))"
