"""A PySpark-native engine for curating large text and image corpora."""

__version__ = "0.1.0"
