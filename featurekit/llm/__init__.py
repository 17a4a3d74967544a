"""Training-data pipeline operators (ten, one module each) and their queries.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
