"""Operators that prepare training text: tokens, packing, near-duplicates, quality, toxicity, licences.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py``
uses it.
"""
