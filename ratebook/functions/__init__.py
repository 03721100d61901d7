"""Column -> Column expressions (JVM-side, whole-stage codegen, no UDFs)."""

from ratebook.functions.text import (  # noqa: F401
    trim_ws, snake, clean_hsn, strip_hsn, dec_text, stable_id, cache_key,
    chapter_of, col_of,
)
from ratebook.functions.rates import parse_rate, coerce_rate, RATE_TYPE  # noqa: F401
from ratebook.functions.dates import parse_date  # noqa: F401
