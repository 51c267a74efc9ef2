"""Operators that prepare text for training language models.

Each module holds one operator with a general interface; ``queries`` applies them to the
test tables.  Nothing outside this folder imports it.
"""
