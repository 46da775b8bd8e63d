"""Batch jobs for large bilingual collections of public reports, as Spark DataFrame transformations."""
