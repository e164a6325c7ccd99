"""cartwheel -- retail star-schema analytics on Spark DataFrames.

Sources bind raw tables (parquet or catalog) to three lazy frames;
operators are ``Shop -> DataFrame`` functions; functions hold the business
rules as native expressions with UDF twins; plans hold the saved ETL jobs,
the rerun-safe sink and the job registry.
"""

__version__ = "0.1.0"
