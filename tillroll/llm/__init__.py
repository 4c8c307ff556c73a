"""Operators for preparing language-model training data.

Every operator takes and returns DataFrames; ``queries`` binds them to the driver's tables.
Nothing outside this subpackage imports it.
"""
