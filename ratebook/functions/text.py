"""String, hash and code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook.fixed import CACHE_SUFFIX, ID_SEPARATOR

# Java regexes; (?U) makes \s match Unicode white space as Python's str.strip does.
_WS_EDGES = r"(?U)^\s+|\s+$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip leading/trailing white space of any kind (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(col_of(c), _WS_EDGES, "")


def snake(c: Column | str) -> Column:
    """Header -> snake_case: trim, lower, runs outside [a-z0-9] -> '_', strip '_'."""
    s = F.regexp_replace(F.lower(trim_ws(c)), "[^a-z0-9]+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")


def clean_hsn(c: Column | str) -> Column:
    """Table-level code cleaning: trim; drop dots, white space and dashes; strip
    leading and trailing non-digits (inner letters stay); null -> ''."""
    # Every white space character is removed here, so no separate trim.
    s = F.regexp_replace(F.coalesce(col_of(c).cast("string"), F.lit("")), r"(?U)[.\s\-]", "")
    s = F.regexp_replace(s, "^[^0-9]+", "")
    return F.regexp_replace(s, "[^0-9]+$", "")


def strip_hsn(c: Column | str) -> Column:
    """Record-level code cleaning: trim, drop '.' and ' '; null -> ''."""
    s = trim_ws(F.coalesce(col_of(c).cast("string"), F.lit("")))
    return F.translate(s, ". ", "")


def dec_text(c: Column | str) -> Column:
    """Canonical decimal text: fixed-scale text with trailing zeros removed
    (5.000000 -> '5', 2.500000 -> '2.5'). Used wherever a rate enters an id
    or a key, so 5 and 5.0 are the same rate."""
    s = col_of(c).cast(T.DecimalType(24, 6)).cast("string")
    return F.regexp_replace(s, r"\.?0+$", "")


def stable_id(*cols: Column | str) -> Column:
    """First 16 hex digits of sha256 over the '|'-joined texts (nulls as '')."""
    parts = [F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols]
    return F.substring(F.sha2(F.concat_ws(ID_SEPARATOR, *parts), 256), 1, 16)


def chapter_of(code: Column | str) -> Column:
    """Integer value of the first two characters of a code, or null when the
    code is shorter than 2 or those characters are not an integer."""
    c = col_of(code)
    return F.when(F.length(c) >= 2, F.substring(c, 1, 2).try_cast("int"))


def cache_key(url: Column | str, suffix: str = CACHE_SUFFIX) -> Column:
    """Page cache name: network location with '.' -> '_', '_', first 12 hex of
    md5(url), suffix."""
    u = col_of(url)
    netloc = F.coalesce(F.try_parse_url(u, F.lit("AUTHORITY")), F.lit(""))
    return F.concat(F.translate(netloc, ".", "_"), F.lit("_"),
                    F.substring(F.md5(u), 1, 12), F.lit(suffix))
