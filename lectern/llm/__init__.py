"""Training-data operators: one module per operator, plus their registry in ``registry``.

Nothing outside this subpackage imports it, except the guarded import in ``__spark_entry__``.
"""
