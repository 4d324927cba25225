"""Spark-native cryptographic-inventory risk analytics."""
