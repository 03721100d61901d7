"""Render a fixed text format (``ratebook.fixed``) as a Spark string expression."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def render(fmt: str, **fields: Column) -> Column:
    """``render("a={x}!", x=col)`` -> concat('a=', col, '!'); each field is a Column."""
    parts = []
    for literal, name, _spec, _conv in string.Formatter().parse(fmt):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(fields[name])
    return F.concat(*parts) if len(parts) > 1 else parts[0]
