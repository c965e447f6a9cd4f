"""tillroll: retail supply-chain analytics as composable Spark DataFrame operators.

Sub-packages
------------
sources    readers/writers: raw CSVs, the star schema, adapter views over parquet
functions  column expressions (safe division, null-safe clipping, title case, ...)
operators  DataFrame -> DataFrame analytics (cleaning, profiling, KPIs, ranking,
           ABC, time series, forecasting, anomalies, segmentation, recommender)
plans      named queries (the SQL library, measures, views) and their oracle SQL
"""

__version__ = "0.1.0"
