"""Operators of a training-data pipeline: one module per operator, none imported by the rest of the library."""
