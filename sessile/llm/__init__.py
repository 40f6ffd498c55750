"""Operators of a training-data pipeline over text, pages and vectors.

Every module holds one operator with its own interface; ``queries`` registers
one ``opN_<name>`` query for each.  Nothing outside this folder imports it.
"""
