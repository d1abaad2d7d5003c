"""HTML pages to text."""

from __future__ import annotations

import html.entities

from digestloom.functions.arrays import (
    blank_to_null, fold, keep, let, lit, struct, transform, zip_with,
)
from digestloom.functions.text import strip

# Marks the place of a removed tag, comment or element: text on both sides stays separate.
BREAK = "\x01"

RAW_TEXT_ELEMENTS = ("script", "style")
# Elements inside a body that hold no article text.
DROPPED_ELEMENTS = ("script", "style", "figure", "iframe", "ins")

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"""</?[a-zA-Z]{_ATTRIBUTES}>|</?[a-zA-Z][^>]*>|<[!?][^>]*>"""


def _replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(by)})"


def _like(text: str, pattern: str) -> str:
    return f"regexp_like({text}, {lit(pattern)})"


def _extract(text: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({text}, {lit(pattern)}, {group})"


def drop_hidden(page: str) -> str:
    """Remove comments and raw-text elements, whose content may look like markup."""
    raw = "|".join(rf"<{tag}\b[^>]*>.*?(?:</{tag}\s*>|\z)" for tag in RAW_TEXT_ELEMENTS)
    return _replace(page, rf"(?is)<!--.*?(?:-->|\z)|{raw}", BREAK)


def _start_tag(selector: str) -> str:
    """Regex of a start tag for ``#id``, ``.class`` or a tag name; group 1 is the tag name."""
    name = "([a-zA-Z][a-zA-Z0-9]*)"
    value = selector[1:]
    if selector.startswith("#"):
        return rf"""(?is)<{name}(?=\s)[^>]*?\sid\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>]))[^>]*>"""
    if selector.startswith("."):
        return (
            rf"""(?is)<{name}(?=\s)[^>]*?\sclass\s*=\s*(?:"(?:[^"]*\s)?{value}(?:\s[^"]*)?\""""
            rf"""|'(?:[^']*\s)?{value}(?:\s[^']*)?'|{value}(?=[\s>]))[^>]*>"""
        )
    return rf"(?is)<({selector})\b[^>]*>"


def _until_closed(rest: str, tag: str) -> str:
    """Head of ``rest`` up to the end tag that balances an already opened ``tag``.

    ``rest`` and ``tag`` are lambda values, so repeating them costs nothing.
    """
    pieces = rf"split({rest}, concat('(?i)(?=</?', {tag}, '\\b)'))"
    opens = rf"concat('(?i)^<', {tag}, '\\b')"
    any_tag = rf"concat('(?i)^</?', {tag}, '\\b')"

    def step(acc: str, piece: str) -> str:
        change = (
            f"CASE WHEN regexp_like({piece}, {opens}) THEN 1 "
            f"WHEN startswith({piece}, '</') THEN -1 ELSE 0 END"
        )
        moved = let(
            f"{acc}.depth + {change}",
            lambda d: struct(depth=d, kept=f"{acc}.kept + CASE WHEN {d} > 0 THEN 1 ELSE 0 END"),
        )
        return f"CASE WHEN {acc}.depth > 0 THEN {moved} ELSE {acc} END"

    # Only an end tag of this element may lower the depth, so another tag at the very
    # beginning is shielded.
    shielded = transform(
        pieces,
        lambda p, i: f"CASE WHEN {i} = 0 AND NOT regexp_like({p}, {any_tag}) "
        f"THEN concat({lit(BREAK)}, {p}) ELSE {p} END",
    )
    return let(
        shielded,
        lambda ps: f"array_join(slice({ps}, 1, {fold(ps, struct(depth='1', kept='0'), step)}.kept), '')",
    )


def select_first(page: str, selector: str) -> str:
    """Inner HTML of the first element that matches, null when there is none."""
    start = _start_tag(selector)
    found = let(
        page,
        lambda p: struct(tag=_extract(p, start), rest=f"get(split({p}, {lit(start)}, 2), 1)"),
    )
    return let(
        found,
        lambda m: f"CASE WHEN {m}.tag <> '' THEN {_until_closed(f'{m}.rest', f'{m}.tag')} END",
    )


def select_all(page: str, selector: str) -> str:
    """Inner HTML of every element that matches, in page order."""
    start = lit(_start_tag(selector))

    def pairs(p: str) -> str:
        rests = f"split({p}, {start})"
        return zip_with(
            f"regexp_extract_all({p}, {start}, 1)",
            let(rests, lambda r: f"slice({r}, 2, greatest(size({r}) - 1, 0))"),
            lambda t, r: struct(tag=t, rest=r),
        )

    return transform(let(page, pairs), lambda m: _until_closed(f"{m}.rest", f"{m}.tag"))


def drop_elements(fragment: str, tags: tuple[str, ...] = DROPPED_ELEMENTS) -> str:
    """Remove elements with their content, nested ones included."""

    def without(text: str, tag: str) -> str:
        if tag in RAW_TEXT_ELEMENTS:
            return _replace(text, rf"(?is)<{tag}\b[^>]*>.*?(?:</{tag}\s*>|\z)", BREAK)
        return let(
            text,
            lambda t: f"CASE WHEN {_like(t, rf'(?i)<{tag}\b')} THEN {_drop_nested(t, tag)} ELSE {t} END",
        )

    for tag in tags:
        fragment = without(fragment, tag)
    return fragment


def _drop_nested(fragment: str, tag: str) -> str:
    pieces = f"split({fragment}, {lit(rf'(?i)(?=</?{tag}\b)')})"

    def step(acc: str, piece: str) -> str:
        change = (
            f"CASE WHEN {_like(piece, rf'(?i)^<{tag}\b')} THEN 1 "
            f"WHEN {_like(piece, rf'(?i)^</{tag}\b')} THEN -1 ELSE 0 END"
        )
        rest = _replace(piece, rf"(?i)^</{tag}\b[^>]*>", BREAK)
        return let(
            f"greatest(0, {acc}.depth + {change})",
            lambda d: struct(
                depth=d,
                kept=f"CASE WHEN {d} = 0 THEN concat({acc}.kept, array({rest})) ELSE {acc}.kept END",
            ),
        )

    start = struct(depth="0", kept="CAST(array() AS ARRAY<STRING>)")
    return f"array_join({fold(pieces, start, step)}.kept, {lit(BREAK)})"


def _entities() -> str:
    """Named entities as one literal, which the optimiser folds into a map."""
    named = {name: chr(code) for name, code in html.entities.name2codepoint.items()} | {"apos": "'"}
    pairs = "\x03".join(f"{name}\x02{char}" for name, char in sorted(named.items()))
    return f"str_to_map({lit(pairs)}, {lit(chr(3))}, {lit(chr(2))})"


def _char(code: str) -> str:
    valid = f"{code} > 0 AND {code} < 1114112 AND {code} NOT BETWEEN 55296 AND 57343"
    known = f"CASE WHEN {valid} THEN {code} ELSE 65533 END"
    return f"decode(unhex(lpad(hex({known}), 8, '0')), 'UTF-32')"


def decode_entities(text: str) -> str:
    """Decode named and numeric entities, each exactly once, left to right."""
    name = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"

    def value(found: str) -> str:
        digits = _extract(found, "^#[xX]?([0-9a-fA-F]+)$")
        code = (
            f"CASE WHEN {_like(found, '^#[xX]')} THEN try_cast(conv({digits}, 16, 10) AS BIGINT) "
            f"ELSE try_cast({digits} AS BIGINT) END"
        )
        return (
            f"CASE WHEN startswith({found}, '#') THEN {let(code, _char)} "
            f"ELSE try_element_at({_entities()}, {found}) END"
        )

    def decode(piece: str, i: str) -> str:
        char = let(_extract(piece, name), value)
        return (
            f"CASE WHEN {i} = 0 THEN {piece} ELSE "
            f"coalesce(concat({char}, {_replace(piece, name, '')}), concat('&', {piece})) END"
        )

    return let(
        text,
        lambda t: f"CASE WHEN contains({t}, '&') "
        f"THEN array_join({transform(f'''split({t}, '&')''', decode)}, '') ELSE {t} END",
    )


def element_text(fragment: str, separator: str) -> str:
    """Text nodes, stripped, blank ones dropped, joined with ``separator``."""
    marked = decode_entities(_replace(fragment, _TAG, BREAK))
    nodes = keep(transform(f"split({marked}, {lit(BREAK)})", strip), lambda t: f"{t} <> ''")
    return f"array_join({nodes}, {lit(separator)})"


def title(page: str, selector: str = "#article_title_h2") -> str:
    """Title element, else the ``og:title`` meta tag, else empty."""
    metas = f"regexp_extract_all({page}, {lit(rf'(?is)(<meta\b{_ATTRIBUTES}>)')}, 1)"
    is_og = r"""(?is)\sproperty\s*=\s*["']?og:title["'\s>/]"""
    og = let(
        f"get({keep(metas, lambda m: _like(m, is_og))}, 0)",
        lambda m: "coalesce("
        + blank_to_null(_extract(m, r'(?is)\scontent\s*=\s*"([^"]*)"'))
        + f", {_extract(m, r'''(?is)\scontent\s*=\s*'([^']*)\'''')})",
    )
    return (
        f"coalesce({element_text(select_first(page, selector), '')}, "
        f"{strip(decode_entities(og))}, '')"
    )


def published_at(page: str, within: tuple[str, ...] = (".timewrap", ".time"),
                 element: str = "time", marker: str = "발행일") -> str:
    """Text after the first colon of the marked time element, else of the first one, else empty."""

    def inside(regions: str, selector: str) -> str:
        return f"flatten({transform(regions, lambda r: select_all(r, selector))})"

    regions = f"array({page})"
    for selector in (*within, element):
        regions = inside(regions, selector)

    def after_colon(text: str) -> str:
        return strip(f"regexp_replace({text}, '(?s)^[^:]*:', '')")

    def pick(times: str) -> str:
        marked = keep(times, lambda t: f"contains({t}, {lit(marker)})")
        return (
            f"coalesce({blank_to_null(after_colon(f'get({marked}, 0)'))}, "
            f"{after_colon(f'get({times}, 0)')}, '')"
        )

    return let(transform(regions, lambda t: element_text(t, "")), pick)


def body_text(page: str, selector: str = "#articleBody") -> str:
    """Article text, one text node per line; empty when the body is missing."""
    body = element_text(drop_elements(select_first(page, selector)), "\n")
    return f"coalesce({body}, '')"
