"""Skew-safe ordered computations and the queries bound to the test tables."""
