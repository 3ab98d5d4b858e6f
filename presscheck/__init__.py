"""Scoring of news articles as fake or real on Spark, in batch and in streams."""
