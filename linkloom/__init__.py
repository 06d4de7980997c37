"""A PySpark-native record-linkage and corpus-preparation engine."""
