"""Schemas, raw tables and the partitioned table layout."""
