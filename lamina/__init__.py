"""lamina: a Spark-native engine for turning text collections into verified knowledge tables."""

__version__ = "0.1.0"
