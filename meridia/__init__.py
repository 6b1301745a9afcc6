"""Meridia: a Spark-native engine for wiki-activity analytics."""
