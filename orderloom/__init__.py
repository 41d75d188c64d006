"""Spark-native, versioned order analytics."""
