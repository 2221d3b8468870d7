"""Operators for preparing training data: quality, toxicity, mixing, duplicates, search, urls, pages, tokens."""
