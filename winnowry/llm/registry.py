"""The queries of the operators, by name."""

from __future__ import annotations

from .decontaminate import op7_decontaminate
from .html_blocks import op10_html_blocks
from .jaccard import op9_jaccard_join
from .merkle import op13_merkle
from .packing import op8_pack
from .quality import op4_quality
from .spelling import op11_spelling
from .statements import LOW, MERKLE, SPELLING
from .substrings import op3_substrings
from .token_store import op2_token_store
from .topk import op6_top_k
from .toxicity import op1_toxicity
from .transducer import op12_transducer
from .warc import op5_warc

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_store": op2_token_store,
    "op3_substrings": op3_substrings,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_top_k": op6_top_k,
    "op7_decontaminate": op7_decontaminate,
    "op8_pack": op8_pack,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_html_blocks": op10_html_blocks,
    "op11_spelling": op11_spelling,
    "op12_transducer": op12_transducer,
    "op13_merkle": op13_merkle,
}

WARC = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages), f AS (SELECT h, n, min(page_id) AS first FROM p GROUP BY h, n),
v AS (SELECT page_id, n, h, first, list_transform(range(0, 8), lambda i: ('0x' || substr(h, (5 * i + 1)::BIGINT, 5))::BIGINT) AS v FROM p JOIN f USING (h, n))
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM v"""

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 10"""

DECONTAMINATE = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
occ AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

JACCARD = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

#: The others train models, run a tokenizer or compare byte strings at every place, which SQL can't express or not in reasonable time.
ORACLE_SQL: dict[str, str] = {"op5_warc": WARC, "op6_top_k": TOP_K, "op7_decontaminate": DECONTAMINATE, "op9_jaccard_join": JACCARD, "op11_spelling": SPELLING, "op13_merkle": MERKLE}
