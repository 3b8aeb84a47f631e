"""Operators for training-data pipelines, and their queries.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries if it is there.
"""
