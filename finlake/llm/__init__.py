"""Operators for training-data pipelines: one module per operator.

``queries`` registers them, ``oracle`` holds the DuckDB twins. Nothing
outside this package (and ``corpus_pipeline.py``) imports it.
"""
