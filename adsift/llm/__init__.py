"""Operators of a training-data pipeline: one module per operator.

Each operator takes and returns DataFrames and has its own general interface;
``queries`` holds the thin registered queries and their DuckDB SQL.
"""
