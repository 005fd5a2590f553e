"""Training-data operators: one module per operator, their queries in ``queries``.

Nothing outside this folder (but ``corpus_pipeline.py``) imports it.
"""
