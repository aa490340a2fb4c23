"""Operators for training-data pipelines; see README. Nothing else in the library imports this subpackage."""
