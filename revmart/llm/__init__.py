"""Operators for preparing training data: search, tokens, language models, de-duplication, privacy, mixing, shards.

Every module holds one operator with its own general interface; ``queries`` applies each to its whole table.
"""
