"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, selects only the columns that it is told to use (so extra
columns with clashing names are harmless) and states in its docstring what nulls,
empty texts, ties, repeated rows and empty tables yield.
"""
