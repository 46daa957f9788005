"""Training-data operators: ten numbered DataFrame operators and their registered queries.

Nothing outside this folder, `tests/llm` and `corpus_pipeline.py` imports it.
"""
