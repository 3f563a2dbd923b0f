"""Scalar functions, all of them compositions of Spark's built-in functions."""
