"""Operators for large-scale training-data pipelines: decontamination, quality rules,
private data, secrets, quality classification, line and passage deduplication, set
joins, token files and piece encoding.  Nothing else in the library imports this
subpackage; ``queries`` registers one query per operator."""
