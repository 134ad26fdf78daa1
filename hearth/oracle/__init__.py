"""DuckDB SQL twins of every registered query (the correctness oracle).

The driver runs each ``oracle_sql()`` string on DuckDB over the same parquet
tables and compares results with the Spark DataFrame.  The SQL is written
independently of the DataFrame code: only the raw staging view text
(``hearth.sources.testviews``) is shared, so both sides start from identical
inputs and the comparison tests the warehouse logic.
"""
