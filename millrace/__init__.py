"""millrace: a PySpark-native analytics library for labelled text corpora."""
