"""Readers: files, tables, topics and listings."""
