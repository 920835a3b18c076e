"""Operators of a large-scale training-data pipeline, one module each.

``queries.py`` registers one query per operator; nothing outside this folder
(apart from the guarded import in ``__spark_entry__.py`` and the pipeline)
imports it.
"""
