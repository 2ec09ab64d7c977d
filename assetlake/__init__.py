"""PySpark-native engine for large catalogues of binary assets."""
