"""Operators for preparing training text: search, mixing, deduplication, tokens, chat, archives.

Nothing else in the library imports this subpackage.
"""
