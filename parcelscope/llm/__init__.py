"""Operators for preparing training corpora of language models.

One module per operator; ``catalog`` registers one query per operator. Nothing
else in the library imports this subpackage.
"""
