"""Spark-native analytics over periodic financial filings."""
