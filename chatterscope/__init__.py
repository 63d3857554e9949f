"""Spark-native mention and sentiment analytics over streams of short posts."""

__version__ = "0.1.0"
