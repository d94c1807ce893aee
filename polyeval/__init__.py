"""Spark-native multilingual evaluation: benchmark-score extraction,
translation-quality metrics, back-fill and score/metric correlation."""

__version__ = "0.1.0"
