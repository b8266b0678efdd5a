"""Operators for training-data pipelines; nothing else in the library imports them.

Each module holds one operator; ``queries`` holds the registered ``opN_*`` queries and
the DuckDB SQL of those that SQL can express.
"""
