"""PySpark-native web-session event layers and the analytics on top of them."""

__version__ = "0.1.0"
