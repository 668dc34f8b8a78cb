"""Operators of a training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``quantis.llm.queries`` registers one query per operator; the operators
have interfaces of their own in the other modules.
"""
