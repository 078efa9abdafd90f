"""Scalar functions, as Column expressions wherever Spark can express them."""
