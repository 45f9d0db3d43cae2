"""Operators that prepare training text: deduplication, scoring, packing, mixing and formatting.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it, so that it can be removed whole.
"""
