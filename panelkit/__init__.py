"""Spark operators for entity x date panels."""
