"""Operators for training-data pipelines (numbered 1-10), their queries and SQL.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries only if it is there.
"""
