"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this folder, ``corpus_pipeline`` and the guarded import in
``__spark_entry__`` refers to it.
"""
