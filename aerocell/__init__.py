"""Spark-native analytics over aircraft position reports and cell-level weather."""
