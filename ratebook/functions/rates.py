"""Rate text -> decimal percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook.fixed import COERCE_ZERO_WORDS
from ratebook.functions.text import col_of, trim_ws

# A cell's number must fit CELL_TYPE; RATE_TYPE also holds sums of such cells.
RATE_TYPE = T.DecimalType(24, 6)
CELL_TYPE = T.DecimalType(22, 6)


def zero_rate() -> Column:
    return F.lit(0).cast(RATE_TYPE)


def _is_numeric(c: Column, dtype: T.DataType | None) -> bool:
    return isinstance(dtype, T.NumericType)


def parse_rate(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Table-level rate parsing.

    lower/trim; zero words -> 0; drop '%'; keep the text before the first
    'to' (a bare substring) and before the first ' or '; take the first run of
    [0-9.]; not a number -> 0. The sign of text input is lost; numeric input
    (``dtype`` numeric) is kept as is.
    """
    x = col_of(c)
    if _is_numeric(x, dtype):
        return F.coalesce(x.try_cast(CELL_TYPE).cast(RATE_TYPE), zero_rate())
    return F.coalesce(cell_number(x), F.lit(0).cast(CELL_TYPE)).cast(RATE_TYPE)


def cell_number(c: Column | str) -> Column:
    """The number that :func:`parse_rate` takes from a text cell: 0 for null
    and for a text without a number, null for a number too large for a rate.

    Only the pattern decides what is a number, so the cast meets none that it
    would have to refuse by an exception. The zero words need no test of their
    own: none holds another number than 0."""
    x = col_of(c)
    return F.when(x.isNull(), F.lit(0).cast(CELL_TYPE)).otherwise(
        F.concat(F.lit("0"), _number_text(F.lower(trim_ws(x.cast("string"))))).try_cast(CELL_TYPE))


def _number_text(s: Column) -> Column:
    # Cut at the first 'to', then at the first ' or ' (substring_index gives
    # the whole text when the delimiter is absent), then take the first run of
    # digits and dots, if it is a number: '' for '.', '1.2.3' and the like.
    s1 = F.replace(s, F.lit("%"), F.lit(""))
    s3 = F.substring_index(F.substring_index(s1, "to", 1), " or ", 1)
    return F.regexp_extract(s3, r"^[^0-9.]*+([0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?![0-9.])", 1)


def rate_out_of_range(c: Column | str) -> Column:
    """Whether the number that :func:`parse_rate` would take from a text cell
    is a number too large for a rate (the cell then parses as 0)."""
    return cell_number(c).isNull()


def coerce_rate(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Record-level coercion: null -> 0; numbers kept; zero words -> 0; drop
    '%'; the whole remaining text must be a number (sign kept) else 0."""
    x = col_of(c)
    if _is_numeric(x, dtype):
        return F.coalesce(x.try_cast(CELL_TYPE).cast(RATE_TYPE), zero_rate())
    s = F.lower(trim_ws(x.cast("string")))
    num = trim_ws(F.replace(s, F.lit("%"), F.lit(""))).try_cast(CELL_TYPE).cast(RATE_TYPE)
    return (F.when(x.isNull() | s.isin(*COERCE_ZERO_WORDS), zero_rate())
            .otherwise(F.coalesce(num, zero_rate())))
