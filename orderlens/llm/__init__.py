"""Operators for large text and vector corpora.

Nothing else in the library imports this subpackage; of the library it imports one
general helper, :mod:`orderlens.operators.ranking`. Every operator is a function from DataFrames to a DataFrame; the
registered queries with their fixed parameters are in :mod:`orderlens.llm.queries`.
"""
