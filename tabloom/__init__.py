"""A Spark-native analytics engine for public records and large text corpora."""
