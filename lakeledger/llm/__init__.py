"""Operators for preparing training text: tokens, personal data, near
duplicates, page text, web archives, languages, leaks, URLs and quality.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
