"""terrace: layered (landing -> raw -> staging -> common/business -> output) lakehouse
pipelines written as plain PySpark DataFrame / SQL plans.

Sub-packages
------------
sources    readers: tables, SQL, CSV, Parquet, nested JSON, XML, archives, listings
functions  Column-level helpers: casting, dates, text, thresholds
operators  DataFrame -> DataFrame operators: columns, joins, merge, sets
sinks      writes: append, partition overwrite, merge, delete, raw partitions, reports
quality    rule-driven data-quality controls and file controls
plans      user-level jobs: landing -> raw, raw -> staging, staging -> business, reports
streaming  incremental landing with Structured Streaming
"""

__version__ = "0.1.0"
