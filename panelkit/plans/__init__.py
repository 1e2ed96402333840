"""Dimensional model, query suite, and the panel derived from order tables."""
