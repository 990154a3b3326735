"""Readers for daily drops, source-system extracts and the testdata-derived bank tables."""
