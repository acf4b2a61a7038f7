"""Operators of a training-data pipeline (secret and licence scans,
decontamination, exact top-k search, toxicity grades, near-duplicate and
substring removal, packing, token counts, WARC archives).

Nothing outside this package, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` refers to it.
"""
