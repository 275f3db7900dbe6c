"""The corpus queries: name -> query(spark, sf_dir), and their SQL where there is one."""

from __future__ import annotations

from . import align, cotrain, disclosure, langid, mix, mtree, omh, pack, secrets, simhash, tokenfiles, urls, variants

QUERIES = {
    "op1_mix_sources": mix.op1,
    "op2_simhash_golay": simhash.op2,
    "op3_order_minhash": omh.op3,
    "op4_token_files": tokenfiles.op4,
    "op5_mtree_topk": mtree.op5,
    "op6_cotrain_quality": cotrain.op6,
    "op7_url_filter": urls.op7,
    "op8_language_spans": langid.op8,
    "op9_secret_scan": secrets.op9,
    "op10_pack_sequences": pack.op10,
    "op11_token_alignment": align.op11,
    "op12_disclosure": disclosure.op12,
    "op13_spelling_variants": variants.op13,
}

#: Every pair of a question and a candidate: exact in whole numbers (components are floored doubles).
MTREE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 20
"""

#: The others keep to iterative, trained or binary work that SQL does not express; tests/llm holds
#: them against brute force, round trips or held-out accuracy.
ORACLE = {"op1_mix_sources": mix.ORACLE, "op5_mtree_topk": MTREE}
