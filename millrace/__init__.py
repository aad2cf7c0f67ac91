"""PySpark-native analytics over semi-structured commercial documents."""
