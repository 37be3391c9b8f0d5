"""Operators for preparing training data, each with one registered query in ``catalog``."""
