"""Training-data operators: dedup, quality, packing and mixing of document corpora.

Nothing else in the package imports this subpackage.
"""
