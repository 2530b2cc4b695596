"""corpusforge: a PySpark-native engine for text-recognition corpora."""

__version__ = "0.1.0"
