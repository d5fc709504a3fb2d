"""Operators of a training-data pipeline (quality, toxicity, dedup, sharding, archives, tokens).

Each module holds one operator with a general interface; ``catalog`` holds the
registered ``opN_<name>`` queries and their SQL.  Nothing outside this package
imports it, apart from the guarded import in ``__spark_entry__.py``.
"""
