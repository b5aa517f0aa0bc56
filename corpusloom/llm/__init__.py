"""Training-data operators: each module holds one operator, queries.py the registered queries.

Nothing else in the library imports this subpackage.
"""
