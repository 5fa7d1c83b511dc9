"""Registered queries of this folder and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from quillmart.llm.annsearch import op1_multiprobe_ann
from quillmart.llm.bpe import op10_bpe_encode_decode
from quillmart.llm.chat import op2_chat_repair
from quillmart.llm.gridjoin import op4_grid_order_neardup
from quillmart.llm.licenses import op3_license_scan
from quillmart.llm.packing import op7_best_fit_packing
from quillmart.llm.pii import op11_information_sanitisation
from quillmart.llm.secrets import op5_secret_scan
from quillmart.llm.simhash import op6_simhash_neardup
from quillmart.llm.structure import op12_structure_repair
from quillmart.llm.substrings import op8_substring_dedup
from quillmart.llm.toxicity import op9_toxicity
from quillmart.llm.whitening import op13_qdwh_whitening

QUERIES = {
    "op1_multiprobe_ann": op1_multiprobe_ann,
    "op4_grid_order_neardup": op4_grid_order_neardup,
    "op3_license_scan": op3_license_scan,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash_neardup": op6_simhash_neardup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op2_chat_repair": op2_chat_repair,
    "op10_bpe_encode_decode": op10_bpe_encode_decode,
    "op11_information_sanitisation": op11_information_sanitisation,
    "op12_structure_repair": op12_structure_repair,
    "op13_qdwh_whitening": op13_qdwh_whitening,
}

#: op8: every window as text, counted; words under a window found twice go.
REPEATED_WINDOWS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w
  FROM docs, unnest(range(1, len(words) - 33)) AS t(i)),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (w)),
kept AS (
  SELECT r, string_agg(words[p], ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS p FROM docs) ANTI JOIN gone USING (r, p)
  GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

#: op4: all pairs of one label by cosine, and the transitive closure of the links.
LINKED_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (
  SELECT a, b FROM link
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.least_id, e.vec_id)) AS component_id,
  coalesce(e.vec_id = least(e.vec_id, coalesce(c.least_id, e.vec_id)), FALSE) AS kept
FROM embeddings AS e
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) AS n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) AS c ON c.a = e.vec_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_grid_order_neardup": LINKED_VECTORS,
    "op8_substring_dedup": REPEATED_WINDOWS,
}
