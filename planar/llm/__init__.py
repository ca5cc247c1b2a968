"""Operators for training-data pipelines over text and vector tables.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is present.
"""
