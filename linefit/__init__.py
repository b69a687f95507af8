"""Delimited-text ingestion, summaries, feature preparation and linear models on Spark.

The caller owns the session: nothing in this package builds one or sets its configuration.
"""
