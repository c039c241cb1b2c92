"""Operators for training-data pipelines: ten operators, their queries and SQL.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only if it
can be imported. ``queries.py`` holds the thin ``opN_<name>`` queries.
"""
