"""Training-data operators: one module per operator, each with its own query.

Nothing outside this folder imports it except ``__spark_entry__.py`` and
``corpus_pipeline.py``.  Every operator takes the names of the columns it reads,
so tables may carry any further columns; results hold only documented columns.
"""
