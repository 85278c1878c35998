"""Operators over DataFrames: documents, parts, postings, hits."""
