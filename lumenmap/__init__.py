"""Spark-native analytics for sparse maps, localisation evidence and training corpora."""
