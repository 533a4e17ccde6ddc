"""Spark-native harmonization of labelled numeric matrices into audited layers."""
