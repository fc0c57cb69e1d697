"""Spark-native lakehouse feed engine: DataFrame-to-DataFrame operators for layered loads."""
