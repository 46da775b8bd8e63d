"""Schemas, readers and writers of the collection's files."""
