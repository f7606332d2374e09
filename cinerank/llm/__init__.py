"""Training-data operators: quality rules, secret scans, toxicity, mixing,
packing, near / exact / line / substring deduplication, token counts, Merkle
manifest, embedding whitening and near-dedup.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
