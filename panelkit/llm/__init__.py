"""Operators for large training-data pipelines (documents, pages, benchmarks).

Nothing outside this folder imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
