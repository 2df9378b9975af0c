"""Spark-native analytics for recordings of segmented electrochemical cells."""

__version__ = "0.1.0"
