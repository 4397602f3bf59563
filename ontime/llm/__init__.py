"""Training-data operators: extraction, dedup, scoring, scans and packing of text corpora.

Every module holds one operator with its general interface; ``queries`` holds
the thin registered queries and their SQL.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
