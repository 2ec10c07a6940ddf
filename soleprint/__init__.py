"""Clickstream analytics on Spark: enrichment, windowed views and running totals."""
