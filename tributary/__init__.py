"""Spark-native consolidation of multichannel retail sales."""
