"""Operators that prepare text corpora: de-duplication, quality, extraction, tokens, packing, chats.

Nothing else in the library imports this subpackage. Each module documents what it returns for
null, empty, very long, tied and repeated input.
"""
