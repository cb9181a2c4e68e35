"""Training-data operators: one module for each, their queries in ``queries``.

Nothing outside this subpackage imports it.
"""
