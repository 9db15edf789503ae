"""Operators for preparing language-model training text.

Self-contained: nothing else in the library imports this subpackage. Each
operator takes DataFrames and returns DataFrames; ``queries`` wires the ten
registered queries to their tables.
"""
