"""Operators that prepare a text corpus for language-model training.

Every operator takes and returns DataFrames. Nothing outside this subpackage imports it.
"""
