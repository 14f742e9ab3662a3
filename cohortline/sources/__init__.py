"""Readers and writers: CSV sources, tables, models, metrics, parameters."""
