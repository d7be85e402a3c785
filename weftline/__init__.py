"""A Spark-first engine for weighted, hierarchical micro-data and for preparing training data."""
