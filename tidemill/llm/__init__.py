"""Training-data operators: one module for each operator, queries in ``queries``.

Nothing else in the library imports this subpackage.
"""
