"""Operators for preparing training corpora at scale.

Thirteen operators, one module each, all DataFrame in, DataFrame out:

``quality_knn`` ``maxent_lm`` ``pii_bootstrap`` ``chunk_dedup`` ``host_paths``
``suffix_dedup`` ``byte_bpe`` ``secret_scan`` ``circulant_minhash`` ``wu_manber``
``token_alignment`` ``simhash_blocks`` ``spelling_trie``

``queries`` registers one query per operator. Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
