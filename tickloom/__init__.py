"""Spark-native market analytics: versioned raw layer, point-in-time views, rolling measures."""
