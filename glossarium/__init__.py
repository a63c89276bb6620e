"""Glossarium: a Spark-first engine for lexical data."""
