"""Operators for preparing training corpora (one module per operator).

Nothing outside this package imports it.  Every operator takes DataFrames and
returns DataFrames; columns it does not know are carried along, and a column
of the input that has the name of an output column is replaced by it.
"""
