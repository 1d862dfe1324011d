"""Spark-native engine for integrating, querying and propagating annotation claims over ontologies."""
