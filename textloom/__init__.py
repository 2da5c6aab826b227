"""textloom: a Spark-native engine that turns document corpora into labelled text datasets."""

__version__ = "0.1.0"
