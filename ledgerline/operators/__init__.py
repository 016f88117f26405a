"""Distributed operators: report aggregates, joins with a broadcast policy,
top-k and ordering, and vectorized pandas transforms."""
