"""Training-data pipeline operators: tokenizing, extraction, deduplication, filtering, packing.

Nothing outside this subpackage imports it. Each operator takes DataFrames and
returns DataFrames; ``catalog`` holds the registered queries.
"""
