"""Corpus and statement analytics on Spark."""
