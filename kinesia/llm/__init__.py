"""Operators for training-data pipelines: ten operators and their queries.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries
only if it can be imported.
"""
