"""End-to-end pipelines: retail queries, reports, seed/verify and timing
jobs, and the registry of queries checked against DuckDB."""
