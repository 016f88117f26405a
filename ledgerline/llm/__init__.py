"""Training-data pipeline operators (one module each) and their queries.

Nothing outside this package imports it; ``queries`` holds the registered
``opN_<name>`` queries and their SQL.
"""
