"""Operators for training data: deduplication, filters, search, tokens and mixing.

Each module holds one operator with its general interface and the thin query
``opN_<name>`` that applies it to a whole table. Nothing outside this package
imports it.
"""
