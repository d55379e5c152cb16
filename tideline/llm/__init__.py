"""Operators for preparing training data: one module per operator, ``queries`` applies them to the given tables."""
