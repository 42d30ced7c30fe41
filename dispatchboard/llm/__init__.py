"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage; ``queries`` holds its
registered queries and their SQL twins.
"""
