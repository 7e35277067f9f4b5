"""Operators for large training corpora: archives, deduplication, tokens, secrets, mixing, quality.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
