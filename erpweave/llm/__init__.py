"""Training-data operators: one module per operator, queries and SQL twins in ``queries``.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
