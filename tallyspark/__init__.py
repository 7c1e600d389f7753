"""A Spark-native engine for point-in-time financial and market analytics."""
