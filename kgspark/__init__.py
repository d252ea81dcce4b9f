"""PySpark-native engine for knowledge-base dumps: claims, classes, merges, audits."""
