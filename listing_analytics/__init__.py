"""Spark-native analytics over marketplace pages and the listings on them."""
