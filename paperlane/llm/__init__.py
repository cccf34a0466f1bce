"""Operators that prepare training data for language models.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; ``queries`` derives the registered digests from them.
"""
