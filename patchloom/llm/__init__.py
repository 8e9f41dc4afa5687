"""Training-data operators: near-duplicate search, extraction, scoring, packing.

Nothing else in the library imports this subpackage.
"""
