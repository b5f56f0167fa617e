"""Training-data operators: URL rules, token counts, quality, dedup, decontamination, mixing, shards.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
