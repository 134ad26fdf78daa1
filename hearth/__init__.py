"""hearth: a Spark-native home-insurance warehouse and KPI library.

Layers are DataFrames: raw text (staging) -> bronze (stamped copy) ->
silver (typed, deduplicated, rejects split off) -> gold (star schema) ->
KPI measures and report queries.  Everything is written with built-in
``pyspark.sql.functions`` so plans stay inside whole-stage codegen.
"""

__version__ = "0.1.0"
