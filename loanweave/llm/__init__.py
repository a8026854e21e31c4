"""Operators for large text collections: one module each, and their queries in ``queries``.

Nothing else in the package imports this subpackage.
"""
