"""Corpus, ratings, readings, graph and stream analytics as Spark DataFrame operators."""
