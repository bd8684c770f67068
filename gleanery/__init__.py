"""Spark-native text-record extraction and quality-audit engine."""
