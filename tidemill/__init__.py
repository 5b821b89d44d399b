"""Tidemill: a PySpark-native engine for curating text datasets."""

__version__ = "0.1.0"
