"""Operators of a training-data pipeline over a ``documents`` table.

One module per operator, each a DataFrame-in, DataFrame-out function; ``queries``
registers one query per operator. Nothing else in the library imports this subpackage.
"""
