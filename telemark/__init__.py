"""Spark-native analytics for multi-rate robot and sensor logs."""
