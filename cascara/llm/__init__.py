"""Operators and queries of a training-data pipeline.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
from here, so the folder can be removed without touching the rest.
"""
