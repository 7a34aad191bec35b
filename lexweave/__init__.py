"""A PySpark-native analytics engine for lexical graphs and text corpora."""
