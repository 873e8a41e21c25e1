"""Operators of a training-data pipeline (deduplication, tokens, filters, mixing).

Nothing outside this folder (but for the driver's entry file and
``corpus_pipeline.py``) imports it.
"""
