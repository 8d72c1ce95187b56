"""Keyed, ordered stream analytics as Spark DataFrame operators."""
