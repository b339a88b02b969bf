"""A Spark-native engine for land-change analytics."""
