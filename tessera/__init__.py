"""A Spark-native engine that turns a business-registry dump into geocoded points of interest."""
