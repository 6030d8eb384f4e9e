"""Tidewatch: a PySpark-native adverse-event surveillance engine."""
