"""Article ids and the URLs built from them."""

from __future__ import annotations

from digestloom.functions.arrays import blank_to_null, lit
from digestloom.functions.text import strip


def valid_id(article_id: str) -> str:
    """Eight date digits and six serial digits; never null."""
    return f"coalesce(regexp_like({strip(article_id)}, '^[0-9]{{14}}$'), false)"


def id_date(article_id: str) -> str:
    return f"substring({article_id}, 1, 8)"


def id_serial(article_id: str) -> str:
    return f"substring({article_id}, 9, 6)"


def article_url(article_id: str, base_url: str) -> str:
    return f"concat({lit(base_url.rstrip('/') + '/')}, {article_id})"


def id_from_url(url: str) -> str:
    """Last path segment when it is an article id, else null."""
    return blank_to_null(f"regexp_extract({url}, {lit('/([0-9]{14})(?:[?#].*)?$')}, 1)")


def query_param(url: str, name: str, strict: bool = False) -> str:
    """First value of a query parameter; absent gives null, or an error when ``strict``."""
    value = blank_to_null(f"try_parse_url({url}, 'QUERY', {lit(name)})")
    if not strict:
        return value
    message = f"concat({lit(f'no {name}= parameter in ')}, coalesce({url}, 'null'))"
    return f"coalesce({value}, CAST(raise_error({message}) AS STRING))"
