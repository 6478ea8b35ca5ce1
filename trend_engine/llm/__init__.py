"""Operators for training-data pipelines (see README): one module per operator.

Nothing else in the library imports this subpackage.
"""
