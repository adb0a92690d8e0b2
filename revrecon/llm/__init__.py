"""Operators for large text corpora: mixing, packing, scoring, extraction, search, de-duplication, redaction, encoding."""
