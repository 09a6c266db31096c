"""Operators of a large-scale training-data pipeline, each a Spark job over the given tables.

Nothing else in the library imports this subpackage; ``queries`` registers
one thin query per operator.
"""
