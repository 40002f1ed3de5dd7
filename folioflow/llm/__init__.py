"""Training-data operators: scoring, filtering, deduplication, packing and archive handling at corpus scale.

Nothing else in the library imports this subpackage; its queries and their SQL live in ``queries.py``.
"""
