"""Training-data operators (formatting, search, dedup, mixing, extraction, scoring, encoding).

Nothing else in the library imports this subpackage.
"""
