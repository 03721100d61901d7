"""Training-data operators: search, scoring, filters, deduplication, encoding.

Each module holds one operator with its own general interface; ``queries``
binds them to the driver's tables. Nothing outside this subpackage imports it.
"""
