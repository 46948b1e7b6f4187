"""Readers and writers: input tables, the feature table, numbered forecast runs."""
