"""ledgerline — Spark-native retail analytics.

Lazy DataFrame pipelines (``plans``) over sources (``sources``), built from
column helpers (``functions``) and distributed operators (``operators``).
See README.md for the operator map and the scale notes.
"""

__version__ = "0.1.0"
