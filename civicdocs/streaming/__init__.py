"""Incremental runs over arriving exports."""
