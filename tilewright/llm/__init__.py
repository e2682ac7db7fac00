"""Operators for large text corpora: dedup, filters, packing, sharding, output.

Nothing outside this folder imports it, except ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py``.
"""
