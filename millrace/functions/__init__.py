"""Column functions. Every one composes built-in Spark expressions and stays inside the JVM."""

from millrace.functions.dates import add_units, count_units, truncate_to
from millrace.functions.keys import surrogate_key
from millrace.functions.numeric import (
    haversine_distance,
    radians_of,
    safe_add,
    safe_divide,
    safe_subtract,
    width_bucket,
)
from millrace.functions.text import empty_to_null, safe_cast, slug, slugify, text_of
from millrace.functions.web import url_host, url_parameter, url_path

__all__ = [
    "add_units", "count_units", "empty_to_null", "haversine_distance", "radians_of", "safe_add",
    "safe_cast", "safe_divide", "safe_subtract", "slug", "slugify", "surrogate_key", "text_of",
    "truncate_to", "url_host", "url_parameter", "url_path", "width_bucket",
]
