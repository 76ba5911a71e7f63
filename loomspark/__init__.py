"""loomspark: a PySpark-native engine for preparing, mixing and auditing conversational training corpora."""

__version__ = "0.1.0"
