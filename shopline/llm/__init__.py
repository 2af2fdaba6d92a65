"""Operators of a training-data pipeline: quality, language, scoring, archives,
search, near duplicates, personal data, tokenizing and mixing.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
Executors need the package on their Python path (``--py-files`` on a cluster).
"""
