"""Lectern: a PySpark-native engine for hierarchical, multi-language content."""
