"""Training-data operators: quality, toxicity, de-duplication, mixing, sharding, tokens, search.

Nothing else in the library imports this subpackage.
"""
