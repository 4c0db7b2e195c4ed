"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this package.  ``queries`` registers one
``opN_<name>`` query per operator, ``sql`` holds the DuckDB forms.
"""
