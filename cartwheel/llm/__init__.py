"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this subpackage imports it (only the driver entry does, and
only if it can be imported).
"""
