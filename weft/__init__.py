"""weft: Spark-native corpus curation and evaluation analytics."""
