"""Training-data operators: scoring, filtering, deduplication, formatting and token output.

Nothing else in the package imports this subpackage.
"""
