"""Registra: a Spark-native analytics engine for hierarchical legal corpora."""
