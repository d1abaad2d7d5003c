"""Rendering of one post: path, front matter and body."""

from __future__ import annotations

from collections.abc import Sequence

from digestloom.functions.arrays import blank_to_null, let, lit, transform
from digestloom.functions.dates import day_text, post_date_text
from digestloom.functions.slug import slugify
from digestloom.functions.text import strip

# Scalars a YAML reader would not take for the same string when unquoted.
_TYPED = (
    r"^(?:yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF"
    r"|~|null|Null|NULL|=|<<"
    r"|[-+]?0b[0-1_]+|[-+]?0[0-7_]+|[-+]?(?:0|[1-9][0-9_]*)|[-+]?0x[0-9a-fA-F_]+"
    r"|[-+]?[1-9][0-9_]*(?::[0-5]?[0-9])+"
    r"|[-+]?(?:[0-9][0-9_]*)\.[0-9_]*(?:[eE][-+][0-9]+)?|\.[0-9][0-9_]*(?:[eE][-+][0-9]+)?"
    r"|[-+]?[0-9][0-9_]*(?::[0-5]?[0-9])+\.[0-9_]*|[-+]?\.(?:inf|Inf|INF)|\.(?:nan|NaN|NAN)"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[Tt]|[ \t]+)[0-9]{1,2}:[0-9]{2}:[0-9]{2}"
    r"(?:\.[0-9]*)?(?:[ \t]*(?:Z|[-+][0-9]{1,2}(?::?[0-9]{2})?))?)$"
)
# Marks that cannot start, or occur in, a plain YAML scalar.
_MARKED = r"^[#,\[\]{}&*!|>'\"%@`]|^[?:-](?:\s|$)|^---|^\.\.\.|:\s|:$|\s#|^\s|\s$|^$"
_FLOW_MARKED = r"[,?\[\]{}:]"


def yaml_scalar(text: str, in_list: bool = False) -> str:
    """Quote ``text`` when YAML needs it; ``in_list`` adds the rules of a flow list."""
    pattern = f"{_TYPED}|{_MARKED}" + (f"|{_FLOW_MARKED}" if in_list else "")

    def quoted(t: str) -> str:
        escaped = t
        for char, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t")):
            escaped = f"replace({escaped}, {lit(char)}, {lit(code)})"
        single = f"""replace({t}, {lit("'")}, {lit("''")})"""
        return (
            f"""CASE WHEN regexp_like({t}, {lit("[\n\t]")}) THEN concat('"', {escaped}, '"') """
            f"""WHEN regexp_like({t}, {lit(pattern)}) THEN concat({lit("'")}, {single}, {lit("'")}) """
            f"ELSE {t} END"
        )

    return let(text, quoted)


def unquote_yaml(text: str) -> str:
    """Inverse of :func:`yaml_scalar` for one scalar."""

    def plain(t: str) -> str:
        single = f"""replace(regexp_extract({t}, {lit("(?s)^'(.*)'$")}, 1), {lit("''")}, {lit("'")})"""
        double = f"""regexp_extract({t}, {lit('(?s)^"(.*)"$')}, 1)"""
        for code, char in (("\\n", "\n"), ("\\t", "\t"), ('\\"', '"'), ("\\\\", "\\")):
            double = f"replace({double}, {lit(code)}, {lit(char)})"
        return (
            f"""CASE WHEN startswith({t}, {lit("'")}) THEN {single} """
            f"""WHEN startswith({t}, '"') THEN {double} ELSE {t} END"""
        )

    return let(strip(text), plain)


def yaml_list(items: str) -> str:
    inner = transform(items, lambda t: yaml_scalar(t, in_list=True))
    return f"concat('[', array_join({inner}, ', '), ']')"


def slug_or_id(title: str, article_id: str) -> str:
    return f"coalesce({blank_to_null(slugify(title))}, {article_id})"


def post_path(ts: str, slug: str) -> str:
    """``YYYY-MM-DD-<slug>.md``."""
    return f"concat({day_text(ts)}, '-', {slug}, '.md')"


def front_matter(title: str, ts: str, keywords: str, url: str, categories: Sequence[str], layout: str) -> str:
    """Front matter with a fixed key order and flow-style lists."""
    listed = f"array({', '.join(map(lit, categories))})"
    lines = (
        "'---'",
        f"concat('layout: ', {yaml_scalar(lit(layout))})",
        f"concat('title: ', {yaml_scalar(title)})",
        f"concat('date: ', {post_date_text(ts)})",
        f"concat('categories: ', {yaml_list(listed)})",
        f"concat('tags: ', {yaml_list(keywords)})",
        f"concat('source_url: ', {yaml_scalar(url)})",
        "'auto_generated: true'",
        "'---\\n'",
    )
    return f"concat_ws('\\n', {', '.join(lines)})"


def digest_front_matter(day: str, categories: Sequence[str], layout: str) -> str:
    """Front matter of a day's combined post; ``day`` is its date as text."""
    listed = f"array({', '.join(map(lit, categories))})"
    lines = (
        "'---'", f"concat('layout: ', {yaml_scalar(lit(layout))})", f"concat('title: Daily digest ', {day})",
        f"concat('date: ', {day}, ' 00:00:00 +0900')", f"concat('categories: ', {yaml_list(listed)})", "'tags: [daily-digest]'",
        "'auto_generated: true'", "'---'",
    )
    return f"concat_ws('\n', {', '.join(lines)})"


def digest_entry(title: str, url: str, keywords: str, summary: str) -> str:
    """One article in a day's combined post."""
    return f"concat('\n## [', {title}, '](', {url}, ')\n', array_join({keywords}, ', '), '\n\n', {summary})"


def body(keywords: str, summary: str, url: str, section_url: str, section_name: str) -> str:
    """Keywords, summary and the link back to the source."""
    source = (
        f"\n\n---\n*This post was automatically generated from [{section_name}]({section_url}). "
        "[Read original article →]("
    )
    return (
        f"concat({lit('## Keywords\n')}, array_join({keywords}, ', '), {lit('\n\n## Summary\n')}, "
        f"{summary}, {lit(source)}, {url}, {lit(')*\n')})"
    )
