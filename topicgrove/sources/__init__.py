"""Readers of landed post dumps and tables, and the table sinks."""
