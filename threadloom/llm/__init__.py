"""Operators that prepare text for training language models.

Nothing else in the package imports this subpackage. Every operator takes a DataFrame with a text
column and returns a DataFrame; a null text counts as empty unless the operator says otherwise.
"""
