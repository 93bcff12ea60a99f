"""PySpark-native case-record analytics: DataFrame in, DataFrame out."""
