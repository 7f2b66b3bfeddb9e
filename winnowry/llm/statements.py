"""DuckDB SQL of spelling variants and of the Merkle manifest."""

from __future__ import annotations

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc(text: str, table: str) -> str:
    """CRC-32 of a text; table: a list of the steps of the 256 bytes."""
    register = f"list_reduce(list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex({text}), (2 * i + 1)::BIGINT, 2))::BIGINT), lambda c, b: xor(c >> 8, {table}[xor(c & 255, b) + 1]), 4294967295::BIGINT)"
    return f"xor({register}, 4294967295::BIGINT)"


CRC_TABLE = "crc AS (SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT) ORDER BY b) AS steps FROM range(0, 256) t(b))"

SPELLING = rf"""WITH RECURSIVE {CRC_TABLE},
occ AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all({LOW}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY 1, 2),
hashed AS (SELECT w, k, {crc("(coalesce(doc_id::VARCHAR, '') || ':' || w)", "steps")} AS h FROM occ, crc),
words AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 97 = 0 THEN substring(w, 1, (h % length(w))::BIGINT) || substring(w, (h % length(w) + 2)::BIGINT) ELSE w END AS word FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
gaps AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS g FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.g = b.g AND a.i = b.i AND a.word <> b.word
UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.g = b.word UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.g = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(a := -m, b := other)) AS top FROM near GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.a >= 2 * n THEN top.b END AS form, CASE WHEN -top.a >= 2 * n THEN -top.a END AS form_n FROM words LEFT JOIN best ON words.word = best.word),
chain AS (SELECT word, word AS root, 0 AS k FROM forms UNION ALL SELECT chain.word, form, k + 1 FROM chain JOIN forms ON chain.root = forms.word WHERE form IS NOT NULL),
last AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN last USING (word)"""


def field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def tree(name: str, leaves: str) -> str:
    """CTE of all nodes (tree, level, place, digest, n: nodes of the level) over leaves (tree, place, digest)."""
    return f"""{name} AS (SELECT tree, 0 AS level, place, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
UNION ALL SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (n + 15) // 16 FROM {name} WHERE n > 1 GROUP BY tree, level, place // 16, n)"""


def above(place: str, level: str) -> str:
    """Place of the node of a level that stands above a leaf's place."""
    return f"({place} >> (4 * {level}))"


MERKLE = f"""WITH RECURSIVE {CRC_TABLE}, d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf,
CASE WHEN {crc("doc_id::VARCHAR", "steps")} % 5 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS low FROM documents, crc),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d), l AS (SELECT tree, place, leaf AS digest FROM o), {tree("t", "l")},
s AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot FROM t WHERE n = 1), u AS (SELECT '' AS tree, spot AS place, subroot AS digest FROM s), {tree("v", "u")},
runs AS (SELECT o.tree, o.place, 0 AS high, t.level, t.place AS p, t.digest, {above("o.place", "t.level")} AS own FROM o JOIN t ON t.tree = o.tree AND t.n > 1 AND t.place // 16 = {above("o.place", "(t.level + 1)")}
UNION ALL SELECT o.tree, o.place, 1, v.level, v.place, v.digest, {above("spot", "v.level")} FROM o JOIN s ON s.tree = o.tree JOIN v ON v.n > 1 AND v.place // 16 = {above("spot", "(v.level + 1)")}),
sides AS (SELECT tree, place, row_number() OVER (PARTITION BY tree, place ORDER BY high, level) AS step, coalesce(string_agg(digest, '' ORDER BY p) FILTER (p < own), '') AS a, coalesce(string_agg(digest, '' ORDER BY p) FILTER (p > own), '') AS z FROM runs GROUP BY tree, place, high, level),
folds AS (SELECT tree, place, 0::BIGINT AS step, coalesce(low, leaf) AS x FROM o UNION ALL SELECT f.tree, f.place, f.step + 1, sha256(a || x || z) FROM folds f JOIN sides r ON r.tree = f.tree AND r.place = f.place AND r.step = f.step + 1),
folded AS (SELECT tree, place, arg_max(x, step) AS folded_root FROM folds GROUP BY 1, 2), proofs AS (SELECT tree, place, sha256(string_agg(a || z, '' ORDER BY step)) AS proof FROM sides GROUP BY 1, 2), r AS (SELECT digest AS root FROM v WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM o JOIN s ON s.tree = o.tree JOIN folded f ON f.tree = o.tree AND f.place = o.place LEFT JOIN proofs p ON p.tree = o.tree AND p.place = o.place, r"""
