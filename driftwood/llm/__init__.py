"""Training-data operators: records, deduplication, filtering, scoring and mixing of web text."""
