"""Tidewrack: a PySpark-native analytics engine for market-signal text data."""
