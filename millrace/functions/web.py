"""Parts of a URL, cut out of its text.

These follow plain text rules and not the URL standard: a parameter is found wherever ``name=``
occurs, also inside a longer name, and a slash inside the query counts as the start of the path.
``parsed_part`` is the standard-conforming alternative.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_column

# The schemes cut off before looking at host or path.
HOST_SCHEMES = ["android-app://", "http://", "https://"]
PATH_SCHEMES = ["http://", "https://"]


def _without(url: Column, schemes: list[str]) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def _piece(text: Column, delimiter: str, number: int) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(number))


def url_host(url) -> Column:
    return _piece(_piece(_without(as_column(url), HOST_SCHEMES), "/", 1), "?", 1)


def url_path(url) -> Column:
    """Path without its leading slash and without the query; the whole text if it has neither."""
    text = _without(as_column(url), PATH_SCHEMES)
    slash = F.nullif(F.position(F.lit("/"), text), F.lit(0))
    start = F.coalesce(slash, F.position(F.lit("?"), text) - 1)
    return _piece(F.right(text, F.length(text) - start), "?", 1)


def url_parameter(url, name: str) -> Column:
    """Value after ``name=`` up to the next ``&``; NULL when missing or empty."""
    return F.nullif(_piece(_piece(as_column(url), f"{name}=", 2), "&", 1), F.lit(""))


def parsed_part(url, part: str, key: str | None = None) -> Column:
    """Part of a URL by the standard (``HOST``, ``PATH``, ``QUERY``); NULL when it is not a URL."""
    extra = [] if key is None else [F.lit(key)]
    return F.try_parse_url(as_column(url), F.lit(part), *extra)
