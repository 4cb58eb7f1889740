"""Training-data operators over a table of documents. Nothing outside this
folder (and ``corpus_pipeline.py``) imports it; modules are imported one by
one so that a Python worker loads only what its task needs."""
