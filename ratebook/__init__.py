"""ratebook: tax-rate table building and lookup as Spark DataFrame operators.

Every operator is a DataFrame-in / DataFrame-out function built from Spark
expressions, joins, windows and aggregates. Column names default to the
canonical record schema (``ratebook.schemas.RECORD``) but are parameters,
so the operators run on any table with suitable columns.
"""

__version__ = "0.1.0"
