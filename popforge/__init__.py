"""A Spark-native engine for building calibrated population microdata."""
