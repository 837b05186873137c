"""Operators shared by the plans: skew handling, chunked windows, load patterns, quantiles."""
