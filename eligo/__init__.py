"""eligo: user-offer eligibility state on Spark.

Pure DataFrame -> DataFrame building blocks (``functions``, ``operators``),
the readers and writers around them (``sources``, ``sinks``), and the
query registry checked against DuckDB (``plans``).  No UDFs.
"""

__all__ = ["schemas"]
