"""Training-corpus operators: deduplication, filtering, counting and packing of documents.

Nothing outside this subpackage imports it.
"""
