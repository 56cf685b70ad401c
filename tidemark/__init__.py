"""Incremental ingestion of JSON order messages on Spark.

Every operator is a plain function from DataFrames to a DataFrame; the job and
the stream are compositions of them.
"""
