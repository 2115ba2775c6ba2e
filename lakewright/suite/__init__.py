"""Registered check queries: each key has a Spark implementation (``spark_side``)
and, where SQL can say the same thing, an oracle query (``oracle``) run by DuckDB
over the same parquet tables."""
