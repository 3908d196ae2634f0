"""Training-data operators: one module per operator, plus their registered queries.

Nothing else in the package imports this subpackage; it may be removed whole.
"""
