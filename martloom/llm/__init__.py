"""Operators of a training-data pipeline over text tables.

Each module holds one operator with its own general interface; ``queries``
applies each to its whole table. Nothing outside this package imports it.
"""
