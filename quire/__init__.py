"""Declarative Spark operators over document corpora."""
