"""A PySpark-native engine for agent-trace analytics."""

__version__ = "0.1.0"
