"""laurel: Spark-native ranking of entities within topic x region groups."""
