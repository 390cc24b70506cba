"""Operators of a training-data pipeline over document and page tables.

Each module holds one operator with its general interface; ``queries`` holds
the registered queries, ``sql`` their DuckDB texts.  Nothing else in the
library imports this package.
"""
