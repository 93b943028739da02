"""PySpark-native analytics for object-detection records."""
