"""Spark-native feature engine for news articles, entity time series and trade ledgers."""
