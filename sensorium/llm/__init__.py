"""Operators of a training-data pipeline: packing, similarity join, page text,
URL rules, quality rules, source mixing, exact dedup, personal data, chat
format and license scans.  Nothing outside this package imports it."""
