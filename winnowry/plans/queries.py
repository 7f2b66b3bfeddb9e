"""Named queries over the given tables, each with DuckDB SQL of the same result where SQL can express it.

documents stand in for extracted rows: domain = source, language = lang.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charset, heads, lang, langid, lexicon, scores, url
from ..functions import text as T
from ..functions.simhash import simhash as simhash_of
from ..operators import clusters, neardup, paths, predict, refine, sampling, scoring
from ..sources import archives, sinks, wet
from ..streaming import neardup as streamed
from .session import shared_folder, stored, table

QUERIES = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("domain"), F.col("lang").alias("language"))


def md5(c) -> F.Column:
    return F.md5((F.col(c) if isinstance(c, str) else c).cast("binary"))


CLEAN = T.CLEAN_PATTERN
GARBLE = "length(regexp_replace(substring(text, 1, 300), '[^�Ã©¤¶¼]', '', 'g'))"
TRIMMED = r"regexp_replace(x, '^[\s\p{Z}\x0B\x{85}]+|[\s\p{Z}\x0B\x{85}]+$', '', 'g')"
PARAS = "string_split(text, chr(10))"
SPANS = r"""len(list_filter(range(3, len(string_split_regex(text, '[\p{P}\p{Z}]+'))), lambda i: string_split_regex(text, '[\p{P}\p{Z}]+')[i] = string_split_regex(text, '[\p{P}\p{Z}]+')[i - 1] and string_split_regex(text, '[\p{P}\p{Z}]+')[i - 1] = string_split_regex(text, '[\p{P}\p{Z}]+')[i - 2])) > 0"""
SPANS = r"len(list_filter(range(3, len(w)), lambda i: w[i] = w[i - 1] and w[i - 1] = w[i - 2])) > 0"
SHORT = f"contains(array_to_string(list_transform({PARAS}, lambda x: CASE WHEN strlen({TRIMMED}) < 20 THEN '1' ELSE '0' END), ''), '11111')"
HOST = "lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1))"


@query(f"SELECT doc_id, md5(regexp_replace(text, '{CLEAN}', '', 'g')) AS text_md5, {GARBLE} AS garble_signs FROM documents WHERE strlen(text) >= 200 AND {GARBLE} <= 5")
def extract_filters(spark, sf):
    own = documents(spark, sf).withColumn("garble_signs", T.garble_count(F.col("text")).cast("long"))
    return refine.extract(own).select("doc_id", md5("text").alias("text_md5"), "garble_signs")


@query(f"SELECT doc_id, {GARBLE} AS garble_signs, {GARBLE} <= 5 AS readable FROM documents")
def garble_filter(spark, sf):
    return documents(spark, sf).select("doc_id", T.garble_count(F.col("text")).cast("long").alias("garble_signs"), T.is_readable(F.col("text")).alias("readable"))


@query(f"SELECT doc_id, md5(t) AS text_md5, t <> text AS changed, length(t) AS n FROM (SELECT doc_id, text, regexp_replace(text, '{CLEAN}', '', 'g') AS t FROM documents)")
def clean_regex(spark, sf):
    return documents(spark, sf).withColumn("t", T.clean(F.col("text"))).select("doc_id", md5("t").alias("text_md5"), (F.col("t") != F.col("text")).alias("changed"), F.length("t").cast("long").alias("n"))


@query(f"SELECT page_id, {HOST} AS host, array_to_string(list_reverse(string_split({HOST}, '.')), '.') AS reversed_host FROM pages")
def url_host(spark, sf):
    h = url.domain(F.col("url"))
    return table(spark, sf, "pages").select("page_id", h.alias("host"), url.reverse_host(h).alias("reversed_host"))


@query(f"""WITH p AS (SELECT page_id, url, {HOST} AS host FROM pages), big AS (SELECT host, count(*) // 5 AS parts FROM p GROUP BY host HAVING count(*) >= 5)
SELECT page_id, CASE WHEN parts > 0 THEN p.host || '---' || (('0x' || substr(md5(url), 1, 8))::UBIGINT % parts)::VARCHAR ELSE substring(p.host, 1, 128) END AS domain FROM p LEFT JOIN big ON p.host = big.host""")
def domain_bucket_salt(spark, sf):
    own = table(spark, sf, "pages").select("page_id", "url", url.domain(F.col("url")).alias("host"))
    big = own.groupBy("host").agg(F.floor(F.count("*") / 5).alias("parts")).filter("parts >= 1")
    return own.join(big, "host", "left").select("page_id", url.salted_domain(F.col("host"), F.col("url"), F.coalesce("parts", F.lit(0))).alias("domain"))


@query(f"WITH p AS (SELECT page_id, {HOST} AS host FROM pages) SELECT page_id, host FROM p WHERE host NOT IN (SELECT host FROM p WHERE page_id % 10 = 0)")
def blacklist_anti(spark, sf):
    own = table(spark, sf, "pages").select("page_id", url.domain(F.col("url")).alias("host"))
    return own.join(own.filter("page_id % 10 = 0").select("host").distinct(), "host", "left_anti").select("page_id", "host")


@query(rf"SELECT doc_id, {SPANS} AS repeated FROM (SELECT doc_id, string_split_regex(text, '[\p{{P}}\p{{Z}}]+') AS w FROM documents)")
def span_repeat_filter(spark, sf):
    return documents(spark, sf).select("doc_id", T.has_repeated_spans(F.col("text")).alias("repeated"))


@query(f"SELECT doc_id, {SHORT} AS short_lines FROM documents")
def short_line_filter(spark, sf):
    return documents(spark, sf).select("doc_id", T.has_short_lines(F.col("text")).alias("short_lines"))


@query(f"SELECT doc_id, len({PARAS}) AS n_paras, strlen(text) - len({PARAS}) + 1 AS textlen, strlen(text) // len({PARAS}) AS paralen FROM documents")
def paragraph_split_stats(spark, sf):
    t = F.col("text")
    return documents(spark, sf).select("doc_id", F.size(T.paragraphs(t)).cast("long").alias("n_paras"), T.textlen_bytes(t).cast("long").alias("textlen"), T.paralen(t).alias("paralen"))


@query(f"SELECT doc_id FROM documents WHERE strlen(text) - len({PARAS}) + 1 >= CASE WHEN lang = 'zh' THEN 150 ELSE 250 END")
def textlen_filter(spark, sf):
    return documents(spark, sf).filter(T.textlen_bytes(F.col("text")) >= T.least_textlen(F.col("language"))).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE strlen(text) // len({PARAS}) > 10")
def paralen_filter(spark, sf):
    return documents(spark, sf).filter(T.paralen(F.col("text")) > 10).select("doc_id")


PATTERNS = f"""paras AS (SELECT lang, doc_id, pos, para FROM (SELECT lang, doc_id, unnest({PARAS}) AS para, generate_subscripts({PARAS}, 1) AS pos FROM documents)),
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) >= 7),
support AS (SELECT lang, md5(para) AS para_md5, count(DISTINCT doc_id) AS support FROM paras WHERE strlen(para) > 2 GROUP BY 1, 2),
patterns AS (SELECT lang AS language, para_md5, support FROM support JOIN sizes USING (lang) WHERE support >= 3 AND support >= greatest(3, ceil(n / sqrt(greatest(20, least(500, n // 5))))))"""
BY_LANGUAGE = refine.Config(keys=("language",))


@query(f"WITH {PATTERNS} SELECT language, para_md5, support FROM patterns")
def para_doc_freq(spark, sf):
    return refine.paragraph_patterns(documents(spark, sf), BY_LANGUAGE)


@query(f"""WITH {PATTERNS}, kept AS (SELECT p.*, q.para_md5 IS NULL AS keep FROM paras p LEFT JOIN patterns q ON p.lang = q.language AND md5(p.para) = q.para_md5 AND strlen(p.para) > 2)
SELECT doc_id, md5(coalesce(string_agg(para, chr(10) ORDER BY pos) FILTER (keep), '')) AS text_md5, count(*) FILTER (NOT keep) AS n_removed FROM kept GROUP BY doc_id""")
def para_dedup(spark, sf):
    return refine.dedup_paragraphs(documents(spark, sf), BY_LANGUAGE).select("doc_id", md5("text").alias("text_md5"), "n_removed")


@query(f"""WITH paras AS (SELECT lang, doc_id, unnest({PARAS}) AS para, generate_subscripts({PARAS}, 1) AS pos FROM documents),
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) >= 7),
grams AS (SELECT lang, doc_id, pos, substring(para, i, k) AS g FROM (SELECT *, unnest(range(1, length(para) - k + 2)) AS i FROM (SELECT *, CASE WHEN lang = 'zh' THEN 30 ELSE 50 END AS k FROM paras) WHERE length(para) >= k)),
shared AS (SELECT lang, g FROM (SELECT lang, g, count(DISTINCT doc_id) AS support FROM grams GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 3) JOIN sizes USING (lang) WHERE support >= greatest(3, ceil(n / sqrt(greatest(20, least(500, n // 5)))))),
hit AS (SELECT DISTINCT doc_id, pos FROM grams JOIN shared USING (lang, g)), kept AS (SELECT p.*, h.doc_id IS NULL AS keep FROM paras p LEFT JOIN hit h ON p.doc_id = h.doc_id AND p.pos = h.pos)
SELECT doc_id, md5(coalesce(string_agg(para, chr(10) ORDER BY pos) FILTER (keep), '')) AS text_md5, count(*) FILTER (NOT keep) AS n_removed FROM kept GROUP BY doc_id""")
def block_dedup(spark, sf):
    return refine.dedup_blocks(documents(spark, sf), BY_LANGUAGE).select("doc_id", md5("text").alias("text_md5"), "n_removed")


FLAGS = rf"""f AS (SELECT source AS domain, lang AS language, doc_id, text, {SPANS} AS a, strlen(text) - len({PARAS}) + 1 < CASE WHEN lang = 'zh' THEN 150 ELSE 250 END AS b, {SHORT} AS c,
strlen(text) // len({PARAS}) <= 10 AS d, strlen(text) // len({PARAS}) AS paralen FROM (SELECT *, string_split_regex(text, '[\p{{P}}\p{{Z}}]+') AS w FROM documents)),
s AS (SELECT domain, language, count(*) AS orig_len, count(*) FILTER (a) AS num_span_repeat, count(*) FILTER (NOT a AND b) AS num_short_text, count(*) FILTER (NOT a AND NOT b AND c) AS num_short_lines,
count(*) FILTER (NOT a AND NOT b AND NOT c AND d) AS num_short_paralen, count(*) FILTER (NOT (a OR b OR c OR d)) AS len, round(avg(paralen) FILTER (NOT (a OR b OR c OR d)), 6) AS avg_paralen,
round(avg(strlen(text)) FILTER (NOT (a OR b OR c OR d)), 6) AS avg_textlen FROM f GROUP BY 1, 2)"""


@query(f"WITH {FLAGS} SELECT *, len < 0.4 * orig_len AS dirty FROM s")
def domain_stats(spark, sf):
    return refine.stats(documents(spark, sf))


@query(f"WITH {FLAGS} SELECT domain, language FROM s WHERE len < 0.4 * orig_len OR len < 3")
def dirty_domains(spark, sf):
    return refine.stats(documents(spark, sf)).filter("dirty or len < 3").select("domain", "language")


@query(f"WITH {FLAGS} SELECT doc_id, f.paralen FROM f JOIN s USING (domain, language) WHERE NOT (a OR b OR c OR d) AND NOT (len < 0.4 * orig_len)")
def refine_documents(spark, sf):
    return refine.refine(documents(spark, sf)).select("doc_id", "paralen")


@query(f"""WITH {FLAGS}, q AS (SELECT source AS domain, lang AS language, avg(2 * quality - 1) AS avg_quality FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2)
SELECT domain, language, coalesce(len < 0.1 OR coalesce(avg_quality, 0) < 0 OR avg_paralen < 20 OR len / orig_len < 0.3, false) AS dirty FROM s LEFT JOIN q USING (domain, language)""")
def dirty_rule(spark, sf):
    """The inspection rule over statistics and the labels' mean quality in -1 .. 1, 0 without labels."""
    own = documents(spark, sf)
    quality = own.select("doc_id", "domain", "language").join(table(spark, sf, "labels").select("doc_id", (2 * F.col("quality") - 1).alias("q")), "doc_id").groupBy("domain", "language").agg(F.avg("q").alias("q"))
    found = refine.stats(own).join(quality, ["domain", "language"], "left").withColumn("avg_quality", F.coalesce("q", F.lit(0.0)))
    return found.select("domain", "language", F.coalesce(refine.is_dirty(), F.lit(False)).alias("dirty"))


WORDS = {"en": ["stupid", "idiot", "moron", "trash"], "de": ["schein", "heit"], "fr": ["eaux", "ment"]}
COUNTS = " + ".join(f"CASE WHEN lang = '{k}' THEN (length(text) - length(replace(text, '{w}', ''))) // {len(w)} ELSE 0 END" for k, v in WORDS.items() for w in v)


def tries() -> dict[str, dict]:
    return {k: lexicon.build(v) for k, v in WORDS.items()}


@query(f"SELECT doc_id, ({COUNTS})::BIGINT AS n_hits FROM documents")
def badword_hits(spark, sf):
    return documents(spark, sf).select("doc_id", F.size(lexicon.find_matches(F.col("text"), F.col("language"), tries())).cast("long").alias("n_hits"))


@query(f"""WITH h AS (SELECT doc_id, source AS domain, lang AS language, ({COUNTS}) > 2 AS flagged FROM documents), g AS (SELECT domain, language, count(*) FILTER (flagged) / count(*) > 0.1 AS group_dirty FROM h GROUP BY 1, 2)
SELECT doc_id, domain, language, flagged, group_dirty FROM h JOIN g USING (domain, language)""")
def badword_screen(spark, sf):
    return refine.screen_bad_words(documents(spark, sf), F.size(lexicon.find_matches(F.col("text"), F.col("language"), tries())))


LISTS = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WORDS.items()) + " ELSE []::VARCHAR[] END"
#: The scan's state after each character: what it has of a word, and how many words it has met.
SCAN = """list_reduce(string_split(lower(text), ''), lambda s, c: CASE WHEN len(list_filter(ws, lambda w: starts_with(w, split_part(s, '|', 1) || c))) > 0
THEN split_part(s, '|', 1) || c || '|' || (split_part(s, '|', 2)::INTEGER + CASE WHEN list_contains(ws, split_part(s, '|', 1) || c) THEN 1 ELSE 0 END)::VARCHAR ELSE '|' || split_part(s, '|', 2) END, '|0')"""


@query(f"SELECT doc_id, split_part({SCAN}, '|', 2)::INTEGER <= 2 AS passes FROM (SELECT doc_id, text, {LISTS} AS ws FROM documents)")
def badword_query(spark, sf):
    return documents(spark, sf).select("doc_id", lexicon.query(F.col("text"), F.col("language"), tries(), 2).alias("passes"))


BITS = ", ".join(f"sum(CASE WHEN ({h} >> {b}) & 1 = 1 THEN n ELSE -n END) AS {h}{b}" for h in ("hi", "lo") for b in range(32))
HALF = {h: " + ".join(f"CASE WHEN {h}{b} > 0 THEN {1 << b} ELSE 0 END" for b in range(32)) for h in ("hi", "lo")}
SIMHASH = rf"""t AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS token FROM documents) WHERE token <> '' GROUP BY 1, 2),
d AS (SELECT doc_id, n, ('0x' || substr(md5(token), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(token), 9, 8))::BIGINT AS lo FROM t),
b AS (SELECT doc_id, {BITS} FROM d GROUP BY doc_id), h AS (SELECT doc_id, ({HALF["hi"]})::BIGINT AS hi, ({HALF["lo"]})::BIGINT AS lo FROM b)"""


@query(f"WITH {SIMHASH} SELECT doc_id, hi, lo FROM h")
def simhash(spark, sf):
    return simhash_of(table(spark, sf, "documents"))


FIRSTS = f"{SIMHASH}, e AS (SELECT min(doc_id) AS doc_id, count(*) AS copies, hi, lo FROM h GROUP BY hi, lo)"
PAIRS = f"{FIRSTS}, p AS (SELECT x.doc_id AS a, y.doc_id AS b, (bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)))::INTEGER AS distance FROM e x JOIN e y ON x.doc_id < y.doc_id WHERE bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 2)"


@query(f"WITH {PAIRS} SELECT a, b, distance FROM p")
def neardup_pairs(spark, sf):
    return neardup.pairs(stored(simhash_of(table(spark, sf, "documents")), "simhash"))


@query(f"""WITH RECURSIVE {PAIRS}, l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), r AS (SELECT doc_id, doc_id AS reached FROM e UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT doc_id, min(reached) AS component FROM r GROUP BY doc_id) SELECT h.doc_id, c.component, h.doc_id = c.component AS kept FROM h JOIN e ON h.hi = e.hi AND h.lo = e.lo JOIN c ON c.doc_id = e.doc_id""")
def neardup_keep(spark, sf):
    return neardup.keep(stored(simhash_of(table(spark, sf, "documents")), "simhash"))


@query(f"""WITH {SIMHASH}, o AS (SELECT doc_id, hi, lo, lag(hi) OVER w AS phi, lag(lo) OVER w AS plo FROM h WINDOW w AS (ORDER BY hi, lo, doc_id))
SELECT doc_id, (bit_count(xor(hi, phi)) + bit_count(xor(lo, plo)))::INTEGER AS distance, coalesce(bit_count(xor(hi, phi)) + bit_count(xor(lo, plo)) < 3, false) AS near FROM o""")
def neardup_sorted_neighbours(spark, sf):
    return neardup.neighbours(stored(simhash_of(table(spark, sf, "documents")), "simhash"))


@query(f"WITH {FIRSTS} SELECT hi, lo, doc_id, copies FROM e")
def exact_hash_first(spark, sf):
    return neardup.first_of_hash(simhash_of(table(spark, sf, "documents")))


@query("SELECT source AS domain FROM documents WHERE doc_id % 7 = 0 UNION SELECT source FROM documents WHERE lang = 'es'")
def blacklist_union(spark, sf):
    own = documents(spark, sf)
    return paths.blacklist_with(own.filter("doc_id % 7 = 0"), own.filter("language = 'es'"))


@query("SELECT doc_id, source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 20000)")
def list_difference(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return paths.difference(own, own.filter("n_chars > 20000"), "source").select("doc_id", "source")


@query("SELECT doc_id, CASE WHEN length(text) >= 5 THEN len(range(1, length(text) - 3, 3)) ELSE 0 END AS n, md5(array_to_string(CASE WHEN length(text) >= 5 THEN list_transform(range(1, length(text) - 3, 3), lambda i: substring(text, i, 5)) ELSE []::VARCHAR[] END, '|')) AS grams_md5 FROM documents")
def ngrams(spark, sf):
    g = T.ngrams(F.col("text"), 5, 3)
    return documents(spark, sf).select("doc_id", F.size(g).cast("long").alias("n"), md5(F.array_join(g, "|")).alias("grams_md5"))


def _lcs(n: int, step: int) -> str:
    return f"CASE WHEN length(s) >= {n} THEN list_filter(list_transform(range(1, length(s) - {n} + 2, {step}), lambda i: substring(s, i, {n})), lambda g: contains(l, g) AND NOT contains(g, chr(10)))[1] END"


@query(f"""WITH p AS (SELECT a.doc_id, CASE WHEN strlen(a.text) <= strlen(b.text) THEN a.text ELSE b.text END AS s, CASE WHEN strlen(a.text) <= strlen(b.text) THEN b.text ELSE a.text END AS l FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, coalesce({_lcs(100, 30)}, {_lcs(10, 10)}) AS block FROM p""")
def ngram_lcs(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "text")
    nxt = own.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    return own.join(nxt, "doc_id").select("doc_id", T.ngram_lcs(F.col("text"), F.col("other"), 10).alias("block"))


@query(f"SELECT doc_id, coalesce(list_position(list_transform({PARAS}, lambda p: strlen(p) >= 30 AND contains(p, 'tion')), true), 0)::BIGINT AS place FROM documents")
def ngram_match(spark, sf):
    return documents(spark, sf).select("doc_id", T.ngram_match(F.lit("tion"), T.paragraphs(F.col("text")), 30).cast("long").alias("place"))


#: How long the first piece of r is, of 510 characters at most.
PIECE = r"""CASE WHEN length(r) <= 511 THEN 510 WHEN regexp_matches(substr(r, 2, 509), '(?s)[\n.?!。！？]')
THEN length(regexp_extract(substr(r, 2, 509), '(?s).*[\n.?!。！？]')) + CASE WHEN ends_with(regexp_extract(substr(r, 2, 509), '(?s).*[\n.?!。！？]'), chr(10)) THEN 0 ELSE 1 END ELSE 510 END"""
PIECES = f"""pieces AS (SELECT doc_id, -1 AS pos, '' AS segment, text AS r FROM documents UNION ALL SELECT doc_id, pos + 1, substr(r, 1, k), substr(r, k + 1) FROM (SELECT *, {PIECE} AS k FROM pieces WHERE r <> ''))"""


@query(f"WITH RECURSIVE {PIECES} SELECT doc_id, pos, length(segment)::INTEGER AS n, md5(segment) AS segment_md5 FROM pieces WHERE pos >= 0")
def segment_text(spark, sf):
    own = documents(spark, sf).select("doc_id", F.posexplode(scores.segmented(F.col("text"))).alias("pos", "segment"))
    return own.select("doc_id", "pos", F.length("segment").alias("n"), md5("segment").alias("segment_md5"))


SCORED = f"""s AS (SELECT doc_id, pos - 1 AS pos, segment, ('0x' || substr(md5(doc_id::VARCHAR || ':' || (pos - 1)::VARCHAR), 1, 4))::INTEGER / 65536.0::DOUBLE AS score
FROM (SELECT doc_id, unnest({PARAS}) AS segment, generate_subscripts({PARAS}, 1) AS pos FROM documents))"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with made-up scores."""
    own = documents(spark, sf).select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "segment"))
    return own.withColumn("score", F.conv(F.substring(md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string"))), 1, 4), 16, 10).cast("double") / 65536.0)


@query(f"""WITH {SCORED} SELECT doc_id, md5(coalesce(string_agg(segment, chr(10) ORDER BY pos) FILTER (score > 0.4), '')) AS text_md5, count(*) FILTER (score > 0.4) AS n, round(avg(score) FILTER (score > 0.4), 6) AS mean_score,
CASE WHEN avg(score) FILTER (score > 0.4) > 0.7 THEN 'hq' ELSE 'lowq' END AS bucket FROM s GROUP BY doc_id""")
def segment_scores_select(spark, sf):
    return scores.select_segments(scored(spark, sf), 0.4, 0.7).select("doc_id", md5("text").alias("text_md5"), F.size("scores").cast("long").alias("n"), F.round("mean_score", 6).alias("mean_score"), "bucket")


@query(f"""WITH {SCORED}, g AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM s WHERE score > 0.3)
SELECT doc_id, min(pos)::BIGINT AS first, count(*) AS n, md5(string_agg(segment, '' ORDER BY pos)) AS text_md5 FROM g GROUP BY doc_id, grp""")
def contiguous_high_quality(spark, sf):
    return scores.contiguous(scored(spark, sf), 0.3).select("doc_id", F.col("first").cast("long").alias("first"), "n", md5("text").alias("text_md5"))


@query("SELECT doc_id, least(9.0, greatest(0.5, floor(n_chars / 1000.0 * 2 + 0.5) / 2)) AS halves, least(24.0, greatest(1.0, round_even(n_chars / 1000.0, 0))) AS whole FROM (SELECT doc_id, n_chars::DOUBLE AS n_chars FROM documents)")
def score_clamp(spark, sf):
    x = F.col("n_chars").cast("double") / 1000.0
    return table(spark, sf, "documents").select("doc_id", scores.prompt_score(x, 9).cast("double").alias("halves"), scores.prompt_score(x, 10).cast("double").alias("whole"))


@query("SELECT doc_id, round(0.5 + 8.5 / (1 + exp(-(n_chars::DOUBLE / 1000 - 2))), 6) AS score FROM documents")
def bounded_sigmoid(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(scores.bounded_sigmoid(F.col("n_chars").cast("double") / 1000 - 2, 0.5, 9.0), 6).alias("score"))


DRAWS = "list_transform(range(0, 8), lambda i: ('0x' || substr(md5(doc_id::VARCHAR), (i + 1)::BIGINT, 2))::INTEGER / 255.0::DOUBLE)"


def draws() -> F.Column:
    return F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.conv(F.substr(md5(F.col("doc_id").cast("string")), i, F.lit(2)), 16, 10).cast("double") / 255.0)


@query(f"""WITH d AS (SELECT doc_id, {DRAWS} AS y FROM documents), m AS (SELECT doc_id, y, list_sum(y) / 8 AS p FROM d)
SELECT doc_id, round(-(p * ln(p + 1e-10) + (1 - p) * ln(1 - p + 1e-10)) + list_sum(list_transform(y, lambda v: v * ln(v + 1e-10) + (1 - v) * ln(1 - v + 1e-10))) / 8, 6) AS bald FROM m""")
def bald_acquisition(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(scores.bald(draws()), 6).alias("bald"))


U = "ln((('0x' || substr(md5('{}:' || doc_id::VARCHAR), 1, 8))::BIGINT + 1)::DOUBLE / 4294967297.0::DOUBLE)"
BALD = f"""d AS (SELECT doc_id, lang, {DRAWS} AS y FROM documents), m AS (SELECT doc_id, lang, y, list_sum(y) / 8 AS p FROM d),
bald AS (SELECT doc_id, lang, -(p * ln(p + 1e-10) + (1 - p) * ln(1 - p + 1e-10)) + list_sum(list_transform(y, lambda v: v * ln(v + 1e-10) + (1 - v) * ln(1 - v + 1e-10))) / 8 AS b FROM m)"""


@query(f"""WITH {BALD}, c AS (SELECT doc_id, lang, 1 - (b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()) AS e, b FROM bald),
h AS (SELECT doc_id, 'hard' AS kind FROM bald WHERE b > 0 ORDER BY {U.format(4)} / b DESC, doc_id LIMIT 40), e AS (SELECT doc_id, 'easy' AS kind FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {U.format(5)} / e DESC, doc_id) AS n FROM c WHERE e > 0) WHERE n <= 10)
SELECT * FROM h UNION ALL SELECT * FROM e""")
def bald_samples(spark, sf):
    """Rows drawn by how much their predictions disagree, and of each language by how little."""
    own = table(spark, sf, "documents").select("doc_id", "lang", draws().alias("y"))
    hard = sampling.by_disagreement(own, "y", "doc_id", 40, 4)
    easy = sampling.by_disagreement(own, "y", "doc_id", 10, 5, easy=True, label="lang")
    return hard.select("doc_id", F.lit("hard").alias("kind")).unionByName(easy.select("doc_id", F.lit("easy").alias("kind")))


@query(f"""SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {U.format(6)} / w DESC, doc_id) AS n FROM (SELECT doc_id, quality, CASE WHEN quality = 0 THEN 1 - s ELSE s END AS w
FROM (SELECT doc_id, quality, ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INTEGER / 65536.0::DOUBLE AS s FROM labels)) WHERE w > 0) WHERE n <= 15""")
def score_sample(spark, sf):
    """Rows of each label drawn by score."""
    own = table(spark, sf, "labels").select("doc_id", "quality", (F.conv(F.substring(md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("double") / 65536.0).alias("score"))
    return sampling.by_score(own, "score", "quality", "doc_id", 15, 6).select("doc_id", "quality")


PREDICTED = "r AS (SELECT l.doc_id, l.quality::DOUBLE AS target, ('0x' || substr(md5(l.doc_id::VARCHAR), 1, 4))::INTEGER / 65536.0::DOUBLE AS pred, 0.5::DOUBLE + l.toxic AS weight FROM labels l)"


@query(f"""WITH {PREDICTED}, m AS (SELECT sum(greatest(0, 0.1 - CASE WHEN a.pred > b.pred THEN 1 WHEN a.pred < b.pred THEN -1 ELSE -sign(a.target - b.target) END * (a.weight + b.weight) / 2 * (a.pred - b.pred))) AS s FROM r a, r b)
SELECT round(avg((pred - target) * (pred - target)), 6) AS mse, round(avg((pred - target) * (pred - target) * weight), 6) AS weighted_mse, round(1 - sum(pred * target) / sqrt(sum(pred * pred) * sum(target * target)), 6) AS cosine_loss,
round((SELECT s FROM m) / (count(*) * count(*)), 6) AS margin_loss FROM r""")
def losses(spark, sf):
    own = table(spark, sf, "labels").select(F.col("quality").alias("target"), (F.conv(F.substring(md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("double") / 65536.0).alias("pred"), (F.col("toxic") + F.lit(0.5)).alias("weight"))
    out = scores.losses(own, 0.1, weighted=True)
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY ('0x' || substr(md5('3:' || doc_id::VARCHAR), 1, 8))::BIGINT, doc_id) AS n FROM documents) WHERE n <= 25")
def per_class_sample(spark, sf):
    return sampling.per_class(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 25, 3)


@query("SELECT doc_id, lang, n_chars::DOUBLE AS weight FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY ln((('0x' || substr(md5('1:' || doc_id::VARCHAR), 1, 8))::BIGINT + 1)::DOUBLE / 4294967297.0::DOUBLE) / n_chars::DOUBLE DESC, doc_id) AS n FROM documents WHERE n_chars > 0) WHERE n <= 20")
def weighted_sample(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("weight"))
    return sampling.weighted(own, "weight", "doc_id", 20, 1, "lang")


@query("SELECT doc_id, round((n_chars - lo) / (hi - lo), 6) AS scaled, round(n_chars / total, 9) AS share FROM (SELECT doc_id, n_chars::DOUBLE AS n_chars, min(n_chars::DOUBLE) OVER () AS lo, max(n_chars::DOUBLE) OVER () AS hi, sum(n_chars::DOUBLE) OVER (PARTITION BY lang) AS total FROM documents)")
def normalise(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"))
    return sampling.share(sampling.min_max(own, "n_chars"), "n_chars", "lang").select("doc_id", F.round("scaled", 6).alias("scaled"), F.round("share", 9).alias("share"))


@query("SELECT year(d)::INTEGER AS year, month(d)::INTEGER AS month, strftime(d, '%Y/%m') AS stamp FROM (SELECT unnest(generate_series(DATE '2016-08-01', DATE '2024-03-01', INTERVAL 1 MONTH)) AS d)")
def month_sequence(spark, sf):
    return paths.months(spark, "2016-08-01", "2024-03-01")


LINK = "'crawl-data/CC-MAIN-2019-' || lpad((page_id % 3 + 10)::VARCHAR, 2, '0') || '/segments/' || lpad((155 + page_id % 7)::VARCHAR, 13, '0') || '.' || lpad((page_id % 7)::VARCHAR, 2, '0') || '/wet/CC-MAIN-' || page_id::VARCHAR || '.warc.wet.gz'"


def links(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("page_id")
    text = lambda c: c.cast("string")
    corpus = F.concat(F.lit("CC-MAIN-2019-"), F.lpad(text(p % 3 + 10), 2, "0"))
    link = F.concat(F.lit("crawl-data/"), corpus, F.lit("/segments/"), F.lpad(text(p % 7 + 155), 13, "0"), F.lit("."), F.lpad(text(p % 7), 2, "0"), F.lit("/wet/CC-MAIN-"), text(p), F.lit(".warc.wet.gz"))
    return table(spark, sf, "pages").select("page_id", corpus.alias("corpus"), link.alias("link"))


@query(f"SELECT corpus, segment, array_to_string(list_sort(list(link)), ',') AS links FROM (SELECT substr(link, 12, 15) AS corpus, rtrim(substr(link, 66, 16), '/') AS segment, link FROM (SELECT {LINK} AS link FROM pages)) GROUP BY 1, 2")
def path_group(spark, sf):
    own = paths.by_segment(links(spark, sf))
    return own.withColumn("links", F.array_join("links", ",")).withColumn("corpus", F.substring("corpus", 1, 15)).groupBy("corpus", "segment").agg(F.max("links").alias("links"))


@query(f"SELECT link FROM (SELECT page_id, {LINK} AS link FROM pages) WHERE page_id % 4 <> 0 OR page_id % 8 = 0")
def links_missing(spark, sf):
    own = links(spark, sf)
    name = url.basename(F.col("link"))
    have = own.filter("page_id % 4 = 0").select(name.alias("name")).unionByName(own.filter("page_id % 8 = 0").select(F.concat(name, F.lit(".aria2")).alias("name")))
    return paths.missing(own.select("link"), have)


@query(f"SELECT page_id, array_to_string(list_reverse(string_split({HOST}, '.')), '.') AS reversed_host FROM pages")
def reverse_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", url.reverse_host(url.host(F.col("url"))).alias("reversed_host"))


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 64)::BIGINT AS batch FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) <= (SELECT count(*) - count(*) % 64 FROM documents)")
def maxrecords_batches(spark, sf):
    return sampling.batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 64, whole=True)


@query("SELECT l.doc_id, CASE WHEN l.doc_id % 13 = 0 THEN 1 WHEN l.doc_id % 17 = 0 THEN 0 ELSE quality END AS quality FROM labels l")
def label_revision(spark, sf):
    own = table(spark, sf, "labels").select("doc_id", "quality")
    changes = own.select("doc_id", F.when(F.col("doc_id") % 13 == 0, 1).when(F.col("doc_id") % 17 == 0, 0).alias("new")).filter("new is not null")
    return own.join(changes, "doc_id", "left").select("doc_id", F.coalesce("new", "quality").alias("quality"))


@query("SELECT d.doc_id, d.lang, l.quality AS pseudo_label FROM documents d JOIN labels l USING (doc_id) ")
def pseudo_label_join(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "lang")
    return own.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("pseudo_label")), "doc_id")


@query("SELECT doc_id, md5(array_to_string(string_split(text, ' ')[1:50], ' ')) AS words_md5, md5(substring(replace(text, ' ', ''), 1, 100)) AS chars_md5 FROM documents")
def truncate_text(spark, sf):
    return documents(spark, sf).select("doc_id", md5(T.truncate_words(F.col("text"), 50)).alias("words_md5"), md5(T.truncate_chars(F.col("text"), 100)).alias("chars_md5"))


def _draw(key: str) -> F.Column:
    """A made-up score in 0 .. 1 from the id."""
    return F.conv(F.substring(md5(F.concat(F.lit(key), F.col("doc_id").cast("string"))), 1, 4), 16, 10).cast("double") / 65536.0


def _drawn(key: str) -> str:
    return f"('0x' || substr(md5('{key}' || doc_id::VARCHAR), 1, 4))::INTEGER / 65536.0::DOUBLE"


@query(f"SELECT doc_id, lang_after_dedup = 'fr' OR (language = 'fr' AND lang_score > 0.6) AS target FROM (SELECT doc_id, lang AS language, CASE WHEN {_drawn('a')} < 0.2 THEN 'unknown' ELSE lang END AS lang_after_dedup, {_drawn('b')} AS lang_score FROM documents)")
def lang_partition(spark, sf):
    return refined(spark, sf).select("doc_id", predict.is_target("fr").alias("target"))


TARGETS = f"SELECT doc_id, lang_after_dedup = 'fr' OR (language = 'fr' AND lang_score > 0.6) AS target FROM (SELECT doc_id, lang AS language, CASE WHEN {_drawn('a')} < 0.2 THEN 'unknown' ELSE lang END AS lang_after_dedup, {_drawn('b')} AS lang_score, {_drawn('c')} AS score FROM documents) WHERE score > 0.6"


@query(TARGETS)
def predict_targets(spark, sf):
    score, rest = predict.split(refined(spark, sf), "fr")
    return score.select("doc_id", F.lit(True).alias("target")).unionByName(rest.select("doc_id", F.lit(False).alias("target")))


WORD_IDS = r"list_transform(regexp_extract_all({}, '[^ \t\n\x0B\f\r]+'), lambda w: 104 + ('0x' || substr(md5(w), 1, 4))::INTEGER % 30000)"


@query(f"""WITH t AS (SELECT doc_id, {WORD_IDS.format("text")} AS ids FROM documents), w AS (SELECT doc_id, seq, ids[seq * 62 + 1:seq * 62 + 62] AS part FROM (SELECT *, unnest(range(0, (len(ids) + 61) // 62)) AS seq FROM t))
SELECT doc_id, seq::INTEGER AS seq, md5('101,' || array_to_string(part, ',') || ',102' || repeat(',0', 62 - len(part))) AS ids_md5, len(part) + 2 AS filled FROM w""")
def window_planes(spark, sf):
    """Windows of 64 places over hashed words, as expressions."""
    own = documents(spark, sf).select("doc_id", scoring.hashed_words_of(F.col("text")).alias("tokens"))
    found = scoring.windows(own, 64)
    return found.select("doc_id", "seq", md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("ids_md5"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("long").alias("filled"))


@query(f"""WITH t AS (SELECT doc_id, {WORD_IDS.format("text")} AS ids FROM documents), w AS (SELECT doc_id, list_sum(ids[seq * 62 + 1:seq * 62 + 62]) - 104 * len(ids[seq * 62 + 1:seq * 62 + 62]) AS s, len(ids[seq * 62 + 1:seq * 62 + 62]) AS n FROM (SELECT *, unnest(range(0, (len(ids) + 61) // 62)) AS seq FROM t))
SELECT doc_id, count(n) AS n_windows, round(avg(s / n / 30000), 9) AS mean_score FROM documents LEFT JOIN w USING (doc_id) GROUP BY doc_id""")
def window_scores(spark, sf):
    """Windows of many documents scored in batches of 24."""
    found = scoring.score(documents(spark, sf), scoring.by_window(scoring.hashed_words, 64), scoring.mean_id, length=64, batch=24)
    mean = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("scores"), F.lit(0))
    return found.select("doc_id", F.size("scores").cast("long").alias("n_windows"), F.round(mean, 9).alias("mean_score"))


@query(f"""WITH t AS (SELECT doc_id, {WORD_IDS.format("text")} AS ids FROM documents) SELECT doc_id, round((list_sum(ids) - 104 * len(ids)) / len(ids) / 30000, 9) AS score FROM t WHERE len(ids) BETWEEN 1 AND 510 ORDER BY score DESC, doc_id LIMIT 1000""")
def top_quality(spark, sf):
    """The best scored of the documents that fit in one window."""
    found = scoring.score(documents(spark, sf), scoring.by_window(scoring.hashed_words, 512), scoring.mean_id, batch=24)
    return found.filter(F.size("scores") == 1).select("doc_id", F.round(F.get("scores", F.lit(0)), 9).alias("score")).orderBy(F.desc("score"), "doc_id").limit(1000)


def refined(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as refined rows, with made-up language scores."""
    return documents(spark, sf).select("doc_id", "text", "language", F.when(_draw("a") < 0.2, "unknown").otherwise(F.col("language")).alias("lang_after_dedup"), _draw("b").alias("lang_score"), _draw("c").alias("dedup_after_lang_score"))


PREDICTED_ROWS = rf"""{PIECES}, t AS (SELECT doc_id, pos, segment, {WORD_IDS.format("segment")}[1:510] AS ids FROM pieces WHERE pos >= 0),
sc AS (SELECT doc_id, pos, segment, CASE WHEN len(ids) = 0 THEN 0 ELSE (list_sum(ids) - 104 * len(ids)) / len(ids) / 30000 END AS score FROM t),
b AS (SELECT doc_id, string_agg(segment, chr(10) ORDER BY pos) AS text, count(*) AS n, avg(score) AS mean FROM sc WHERE score > 0.48 GROUP BY doc_id)"""


@query(f"""WITH RECURSIVE {PREDICTED_ROWS} SELECT doc_id, CASE WHEN NOT target THEN 'rest' WHEN mean > 0.51 THEN 'hq' ELSE 'lowq' END AS bucket, md5(CASE WHEN target THEN coalesce(b.text, '') ELSE d.text END) AS text_md5, CASE WHEN target THEN coalesce(n, 0) END AS n_pieces, CASE WHEN target THEN round(mean, 9) END AS mean_scores
FROM ({TARGETS}) JOIN documents d USING (doc_id) LEFT JOIN b USING (doc_id)""")
def predict_documents(spark, sf):
    """Refined rows split by language, scored piece by piece in batches, written as JSON lines by bucket, and read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/scored-{uuid.uuid4().hex}"
    found, rest = predict.scored(refined(spark, sf), scoring.hashed_words, scoring.mean_id, language="fr", score_filter=0.48, threshold=0.51)
    predict.write_scored(found, rest, folder)
    own = spark.read.schema("doc_id long, text string, scores array<double>, mean_scores double, bucket string").json(f"{folder}/scored")
    own = own.select("doc_id", "bucket", md5("text").alias("text_md5"), F.size("scores").cast("long").alias("n_pieces"), F.round("mean_scores", 9).alias("mean_scores"))
    other = spark.read.schema("doc_id long, text string").json(f"{folder}/rest")
    return own.unionByName(other.select("doc_id", F.lit("rest").alias("bucket"), md5("text").alias("text_md5"), F.lit(None).cast("long").alias("n_pieces"), F.lit(None).cast("double").alias("mean_scores")))


@query()
def head_scores(spark, sf):
    """Documents' scores by the token and segment heads over windows of 64 words, with weights by rule."""
    encoder, model = heads.example()
    found = predict.document_scores(documents(spark, sf), scoring.hashed_words, encoder, model, length=64, batch=24)
    return found.select("doc_id", F.round("score", 9).alias("score"))


@query("SELECT ceil(max(n_chars / 510.0))::BIGINT AS most_windows FROM documents")
def windows_needed(spark, sf):
    return predict.windows_needed(table(spark, sf, "documents").select(F.col("n_chars").alias("n")), 512)


@query(f"SELECT l.quality AS pseudo_label, count(*) AS n, round(avg({_drawn('p')}), 6) AS mean_confidence FROM labels l GROUP BY 1")
def mean_confidence(spark, sf):
    return table(spark, sf, "labels").groupBy(F.col("quality").alias("pseudo_label")).agg(F.count("*").alias("n"), F.round(F.avg(_draw("p")), 6).alias("mean_confidence"))


def _near(a: str, b: str) -> str:
    return f"bit_count(xor({a}.hi, {b}.hi)) + bit_count(xor({a}.lo, {b}.lo)) < 3"


#: The walk over the sorted hashes, a row a step: w.ahi, w.alo are the anchor's.
WALK = f"""{SIMHASH}, o AS (SELECT doc_id, hi, lo, row_number() OVER (ORDER BY hi, lo, doc_id) AS i FROM h),
w AS (SELECT i, doc_id, hi, lo, doc_id AS cluster, struct_pack(hi := hi, lo := lo) AS a, false AS member FROM o WHERE i = 1
UNION ALL SELECT o.i, o.doc_id, o.hi, o.lo, CASE WHEN {_near("w.a", "o")} THEN w.cluster WHEN {_near("w", "o")} THEN w.doc_id ELSE o.doc_id END,
CASE WHEN {_near("w.a", "o")} THEN w.a WHEN {_near("w", "o")} THEN struct_pack(hi := w.hi, lo := w.lo) ELSE struct_pack(hi := o.hi, lo := o.lo) END, ({_near("w.a", "o")}) OR ({_near("w", "o")}) FROM w JOIN o ON o.i = w.i + 1)"""


@query(f"WITH RECURSIVE {WALK} SELECT doc_id, cluster, member FROM w")
def neardup_clusters(spark, sf):
    """Clusters of the walk with a moving anchor."""
    return clusters.clusters(simhash_of(table(spark, sf, "documents")))


@query(f"WITH RECURSIVE {WALK} SELECT doc_id // 100 AS file, doc_id % 100 AS row_no FROM w WHERE member")
def bad_rows(spark, sf):
    """Lists of the rows that repeat their cluster's anchor, written by file and read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/bad-rows-{uuid.uuid4().hex}"
    clusters.write_bad_rows(clusters.bad_rows(clusters.clusters(simhash_of(table(spark, sf, "documents"))), 100), folder)
    return clusters.read_bad_rows(spark, folder)


@query(f"WITH {FIRSTS} SELECT h.doc_id, h.hi, h.lo FROM h JOIN e ON h.hi = e.hi AND h.lo = e.lo AND h.doc_id = e.doc_id")
def surviving_hashes(spark, sf):
    """Hash files written, read, merged, and written without repeated rows."""
    folder = f"{shared_folder(spark).rstrip('/')}/hashes-{uuid.uuid4().hex}"
    archives.write_hashes(simhash_of(table(spark, sf, "documents")), folder)
    own = archives.read_hashes(spark, folder)
    bad = own.join(neardup.first_of_hash(own).select("hi", "lo", F.col("doc_id").alias("first")), ["hi", "lo"]).filter("doc_id <> first").select("doc_id")
    archives.write_hashes(neardup.drop_rows(own, bad, ["doc_id"]).orderBy("hi", "lo"), f"{folder}-filtered")
    return archives.read_hashes(spark, f"{folder}-filtered")


@query(f"SELECT link FROM (SELECT page_id, {LINK} AS link FROM pages) WHERE page_id % 5 = 0")
def links_found(spark, sf):
    own = links(spark, sf)
    return own.select("link").join(own.filter("page_id % 5 = 0").select("link"), "link", "left_semi")


@query(f"SELECT DISTINCT substr(link, 12, 15) AS corpus FROM (SELECT {LINK} AS link FROM pages) WHERE substr(link, 12, 15) <> 'CC-MAIN-2019-11'")
def corpora_left(spark, sf):
    own = links(spark, sf).select(F.substring("link", 12, 15).alias("corpus")).distinct()
    return paths.difference(own, own.filter("corpus = 'CC-MAIN-2019-11'"), "corpus")


@query(f"SELECT page_id, replace(substr(link, 12, strpos(link, 'warc') - 13), '/', '-') AS name, replace(substr(short, 12, length(short) - 13), '/', '-') AS cut FROM (SELECT page_id, {LINK} AS link, 'crawl-data/' || page_id::VARCHAR || '/wet.paths.gz' AS short FROM pages)")
def flat_names(spark, sf):
    short = F.concat(F.lit("crawl-data/"), F.col("page_id").cast("string"), F.lit("/wet.paths.gz"))
    return links(spark, sf).select("page_id", url.flat_name(F.col("link")).alias("name"), url.flat_name(short).alias("cut"))


@query("SELECT file, place, doc_id FROM (SELECT doc_id, doc_id // 100 AS file, (row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1)::BIGINT AS place FROM documents) WHERE place % 7 = file % 7")
def selected_rows(spark, sf):
    """Rows at chosen places of files of JSON lines, a file for each hundred ids."""
    folder = f"{shared_folder(spark).rstrip('/')}/places-{uuid.uuid4().hex}"
    own = table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 100).cast("long").alias("file"))
    own.repartition("file").sortWithinPartitions("file", "doc_id").write.partitionBy("file").json(folder)
    rows = sinks.placed(spark.read.schema("doc_id long, file long").json(folder))
    chosen = rows.filter("place % 7 = file % 7").select("file_path", "place")
    return sinks.gather(spark.read.schema("doc_id long, file long").json(folder), chosen).select("file", "place", "doc_id")


@query("SELECT doc_id, md5(substring(text, 1, 512)) AS text_md5 FROM documents ORDER BY ('0x' || substr(md5('5:' || doc_id::VARCHAR), 1, 8))::BIGINT, doc_id LIMIT 20")
def shuffled_view(spark, sf):
    """Twenty rows in random order, cut for a reader."""
    own = table(spark, sf, "documents").orderBy(sampling.draw(F.col("doc_id"), 5), "doc_id").limit(20)
    return own.select("doc_id", md5(F.substring("text", 1, 512)).alias("text_md5"))


@query("SELECT doc_id, md5(text) AS text_md5, CASE WHEN n_chars > 1000 THEN 'hq' ELSE 'lowq' END AS bucket FROM documents")
def buckets_written(spark, sf):
    """Scored rows written as JSON lines by bucket and read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/buckets-{uuid.uuid4().hex}"
    archives.write_buckets(table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("n_chars") > 1000, "hq").otherwise("lowq").alias("bucket")), folder)
    return spark.read.schema("doc_id long, text string, bucket string").json(folder).select("doc_id", md5("text").alias("text_md5"), "bucket")


@query("SELECT source AS domain, doc_id, md5(text) AS text_md5 FROM documents")
def domain_layout(spark, sf):
    """Extracted rows written by domain and read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/domains-{uuid.uuid4().hex}"
    archives.write_by_domain(documents(spark, sf), folder)
    return spark.read.schema(documents(spark, sf).schema).parquet(folder).select("domain", "doc_id", md5("text").alias("text_md5"))


@query("SELECT DISTINCT source AS domain FROM documents WHERE n_chars > 20000")
def domains_written(spark, sf):
    """A domain list written in order and read back, blank lines left out."""
    folder = f"{shared_folder(spark).rstrip('/')}/list-{uuid.uuid4().hex}"
    table(spark, sf, "documents").filter("n_chars > 20000").select(F.col("source").alias("value")).distinct().orderBy("value").write.text(folder)
    return archives.read_lines(spark, folder).select(F.col("value").alias("domain"))


@query("SELECT count(*) AS n_records, count(DISTINCT source) AS n_domains, count(*) FILTER (octet_length(encode(text)) < 200) AS n_short, count(*) FILTER (octet_length(encode(text)) >= 200) AS n_kept FROM documents")
def run_counts(spark, sf):
    short = F.octet_length("text") < 200
    return table(spark, sf, "documents").agg(F.count("*").alias("n_records"), F.count_distinct("source").alias("n_domains"), F.count_if(short).alias("n_short"), F.count_if(~short).alias("n_kept"))


LEAST = "CASE WHEN lang = 'zh' THEN 150 ELSE 250 END"
NEEDED = "greatest(3, ceil(n / sqrt(greatest(20, least(500, n // 5)))))"
FULL = f"strlen(text) - len({PARAS}) + 1 >= {LEAST}"


def _gated(rows: str, share: float) -> str:
    return f"SELECT * FROM {rows} WHERE lang IN (SELECT lang FROM {rows} JOIN tot USING (lang) GROUP BY lang, n0 HAVING count(*) >= {share} * n0)"


def _cut(rows: str, shared: str, out: str, removed: str) -> str:
    """CTEs that take the paragraphs of `shared` (doc_id, pos) out of the texts of `rows`."""
    return f"""{out}_p AS (SELECT p.doc_id, p.pos, p.para, h.doc_id IS NULL AS keep FROM {rows}_p p LEFT JOIN {shared} h ON p.doc_id = h.doc_id AND p.pos = h.pos),
{out}_t AS (SELECT doc_id, coalesce(string_agg(para, chr(10) ORDER BY pos) FILTER (keep), '') AS text, count(*) FILTER (NOT keep) AS {removed} FROM {out}_p GROUP BY doc_id)"""


ROUNDS = rf"""f AS (SELECT doc_id, lang, text, strlen(text) - len({PARAS}) + 1 AS orig_textlen, {SPANS} AS span, {COUNTS} AS h FROM (SELECT *, string_split_regex(text, '[\p{{P}}\p{{Z}}]+') AS w FROM documents)),
tot AS (SELECT lang, count(*) AS n0 FROM f GROUP BY lang), a AS (SELECT * FROM f WHERE NOT span), s AS (SELECT * FROM a WHERE h <= 2 AND lang IN (SELECT lang FROM a GROUP BY lang HAVING count(*) FILTER (h > 2) / count(*) <= 0.1)),
t AS (SELECT * FROM s WHERE {FULL}), g AS ({_gated("t", 0.6)}), g_n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang HAVING count(*) >= 7),
g_p AS (SELECT lang, doc_id, unnest({PARAS}) AS para, generate_subscripts({PARAS}, 1) AS pos FROM g),
pat AS (SELECT lang, para FROM (SELECT lang, para, count(DISTINCT doc_id) AS k FROM g_p WHERE strlen(para) > 2 GROUP BY 1, 2) JOIN g_n USING (lang) WHERE k >= 3 AND k >= {NEEDED}),
hit1 AS (SELECT doc_id, pos FROM g_p JOIN pat USING (lang, para)), {_cut("g", "hit1", "c", "para_removed")},
c AS (SELECT * FROM (SELECT doc_id, lang, c_t.text, orig_textlen, para_removed FROM g JOIN c_t USING (doc_id)) WHERE {FULL}),
e AS ({_gated("c", 0.6)}), e_n AS (SELECT lang, count(*) AS n FROM e GROUP BY lang HAVING count(*) >= 7), e_p AS (SELECT lang, doc_id, unnest({PARAS}) AS para, generate_subscripts({PARAS}, 1) AS pos FROM e),
gr AS (SELECT lang, doc_id, pos, substring(para, i, k) AS x FROM (SELECT *, unnest(range(1, length(para) - k + 2)) AS i FROM (SELECT *, CASE WHEN lang = 'zh' THEN 30 ELSE 50 END AS k FROM e_p) WHERE length(para) >= k)),
bl AS (SELECT lang, x FROM (SELECT lang, x, count(DISTINCT doc_id) AS k FROM gr GROUP BY 1, 2) JOIN e_n USING (lang) WHERE k >= 3 AND k >= {NEEDED}),
hit2 AS (SELECT DISTINCT doc_id, pos FROM gr JOIN bl USING (lang, x)), {_cut("e", "hit2", "b", "block_removed")},
b AS (SELECT * FROM (SELECT doc_id, lang, b_t.text, orig_textlen, para_removed, block_removed FROM e JOIN b_t USING (doc_id)) WHERE {FULL}),
li AS (SELECT * FROM b WHERE NOT {SHORT}), pl AS (SELECT *, strlen(text) // len({PARAS}) AS paralen FROM li WHERE strlen(text) // len({PARAS}) > 10), k AS ({_gated("pl", 0.4)})"""


def _rounds(spark, sf):
    hits = F.size(lexicon.find_matches(F.col("text"), F.col("language"), tries()))
    return refine.rounds(documents(spark, sf), hits, BY_LANGUAGE)


@query(f"WITH {ROUNDS} SELECT doc_id, lang AS language, md5(text) AS text_md5, para_removed, block_removed, paralen, strlen(text) - len({PARAS}) + 1 AS textlen, round(strlen(text) / orig_textlen, 6) AS text_ret_rate FROM k")
def refine_rounds(spark, sf):
    own = _rounds(spark, sf)["kept"]
    return own.select("doc_id", "language", md5("text").alias("text_md5"), "para_removed", "block_removed", "paralen", F.col("textlen").cast("long").alias("textlen"), F.round("text_ret_rate", 6).alias("text_ret_rate"))


@query(f"""WITH {ROUNDS} SELECT lang AS language, n0 AS orig_len, {", ".join(f"(SELECT count(*) FROM {x} WHERE {x}.lang = tot.lang) AS n_{y}" for x, y in (("a", "span"), ("s", "sens"), ("t", "text"), ("c", "paras"), ("b", "blocks"), ("li", "lines"), ("pl", "paralen")))},
coalesce(len, 0) AS len, coalesce(num_dedup_para, 0) AS num_dedup_para, coalesce(num_dedup_block, 0) AS num_dedup_block, avg_paralen, avg_text_ret_rate FROM tot LEFT JOIN (SELECT lang, count(*) AS len, sum(para_removed)::BIGINT AS num_dedup_para, sum(block_removed)::BIGINT AS num_dedup_block,
round(avg(paralen), 6) AS avg_paralen, round(avg(strlen(text) / orig_textlen), 6) AS avg_text_ret_rate FROM k GROUP BY lang) USING (lang)""")
def round_stats(spark, sf):
    return refine.round_stats(_rounds(spark, sf), BY_LANGUAGE)


def crawled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as crawl records: doc_id, uri, date, body."""
    host = F.concat(F.regexp_replace("source", "[^a-z0-9]", "-"), F.lit(".example"))
    own = table(spark, sf, "documents")
    return own.select("doc_id", F.concat(F.lit("https://"), host, F.lit("/"), F.col("doc_id").cast("string")).alias("uri"), F.lit("2024-01-01T00:00:00Z").alias("date"), F.col("text").cast("binary").alias("body"))


@query("""SELECT doc_id, md5(text) AS text_md5, strlen(text) AS n_bytes, NULL AS error, 1::BIGINT AS n FROM documents WHERE doc_id % 50 NOT IN (7, 9)
UNION ALL SELECT NULL, NULL, NULL, CASE doc_id % 50 WHEN 7 THEN 'unreadable length' ELSE 'damaged member' END, count(*) FROM documents WHERE doc_id % 50 IN (7, 9) GROUP BY doc_id % 50""")
def wet_roundtrip(spark, sf):
    """Archives with unreadable lengths and damaged members amid good ones, read back in ranges of 100 kB; errors are counted."""
    folder = f"{shared_folder(spark).rstrip('/')}/wet-{uuid.uuid4().hex}"
    own = crawled(spark, sf)
    length = F.when(F.col("doc_id") % 50 == 7, "12x").otherwise(F.octet_length("body").cast("string"))
    members = own.select("doc_id", wet.compressed(wet.records_of(own, length)).alias("member"))
    broken = F.overlay("member", F.lit(b"\xff" * 24), (F.octet_length("member") / 2).cast("int"))
    wet.write_members(members.select(F.when(F.col("doc_id") % 50 == 9, broken).otherwise(F.col("member")).alias("member")), folder)
    found = wet.read_records(spark, folder, "part-*", size=100_000)
    good = found.filter("error is null").select(F.element_at(F.split("target_uri", "/"), -1).cast("long").alias("doc_id"), F.md5("body").alias("text_md5"), F.octet_length("body").cast("long").alias("n_bytes"), F.lit(None).cast("string").alias("error"), F.lit(1).cast("long").alias("n"))
    bad = found.filter("error is not null").groupBy("error").agg(F.count("*").alias("n"))
    none = F.lit(None)
    return good.unionByName(bad.select(none.cast("long").alias("doc_id"), none.cast("string").alias("text_md5"), none.cast("long").alias("n_bytes"), "error", "n"))


SIGNS = {"en": " the ", "de": " der ", "fr": " les ", "es": " los "}


def _voted(text: F.Column) -> F.Column:
    """A detector as an expression: the language of the sign that stands most often in a text, the first of equals."""
    votes = [F.struct(F.floor((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("lang")) for i, (k, w) in enumerate(SIGNS.items())]
    best = F.array_max(F.array(*votes))
    return F.struct(F.when(best["n"] > 0, best["lang"]).otherwise("unknown").alias("lang"), F.when(best["n"] > 0, 1.0).otherwise(0.0).cast("float").alias("score"))


BEST = "list_max([" + ", ".join(f"struct_pack(n := (length(text) - length(replace(text, '{w}', ''))) // {len(w)}, i := {-i}, lang := '{k}')" for i, (k, w) in enumerate(SIGNS.items())) + "])"


@query(f"""WITH d AS (SELECT *, regexp_replace(source, '[^a-z0-9]', '-', 'g') || '.example' AS host FROM documents), big AS (SELECT host, count(*) // 40 AS parts FROM d GROUP BY host HAVING count(*) >= 40),
x AS (SELECT doc_id, host, text, 'https://' || host || '/' || doc_id::VARCHAR AS uri, {BEST} AS best FROM d WHERE strlen(text) >= 200 AND {GARBLE} <= 5 AND substr(md5(host), 1, 1) >= '4')
SELECT doc_id, best.lang AS language, CASE WHEN parts > 0 THEN x.host || '---' || (('0x' || substr(md5(uri), 1, 8))::UBIGINT % parts)::VARCHAR ELSE x.host END AS domain, md5(regexp_replace(text, '{CLEAN}', '', 'g')) AS text_md5
FROM x LEFT JOIN big USING (host) WHERE best.n > 0 AND best.lang <> 'es'""")
def extract_wet(spark, sf):
    """Archives extracted: screens, blacklist, charset, language, cleaning, split domains, files by domain; and read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/extract-{uuid.uuid4().hex}"
    own = crawled(spark, sf)
    wet.write_records(own, f"{folder}/wet")
    hosts = own.select("doc_id", url.domain(F.col("uri")).alias("domain"))
    large = hosts.groupBy("domain").agg(F.floor(F.count("*") / 40).alias("parts")).filter("parts > 0")
    rows = archives.read_archives(spark, f"{folder}/wet", "part-*")
    found = archives.extracted(rows, lang.decoded, _voted, ["en", "de", "fr"], hosts.filter(F.substring(md5("domain"), 1, 1) < "4"), large)
    archives.write_by_domain(found, f"{folder}/by-domain")
    return spark.read.schema(found.schema).parquet(f"{folder}/by-domain").select(F.element_at(F.split("uri", "/"), -1).cast("long").alias("doc_id"), "language", "domain", md5("text").alias("text_md5"))


SHARE = f"round((list_max([{', '.join(f"(length(text) - length(replace(text, '{w}', ''))) // {len(w)}" for w in SIGNS.values())}]) / nullif(list_sum([{', '.join(f"(length(text) - length(replace(text, '{w}', ''))) // {len(w)}" for w in SIGNS.values())}]), 0))::DOUBLE, 6)"


def _shares(text: F.Column) -> F.Column:
    """A detector as an expression: the language whose sign stands most often in a text, and its share of all signs."""
    counts = [F.floor((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)) for w in SIGNS.values()]
    return F.struct(_voted(text)["lang"].alias("lang"), F.round(F.try_divide(F.greatest(*counts), sum(counts[1:], counts[0])), 6).alias("score"))


FOUND = " UNION ALL ".join(f"SELECT lang, '{w}' AS w FROM a WHERE lang = '{k}' AND contains(text, '{w}')" for k, v in WORDS.items() for w in v)


@query(f"""WITH {ROUNDS}, sw AS (SELECT DISTINCT lang, w FROM ({FOUND})), fb AS (SELECT lang, doc_id, pos, arg_min(x, i) AS x FROM (SELECT gr.lang, gr.doc_id, gr.pos, gr.x, gr.i FROM (SELECT *, unnest(range(1, length(para) - 49)) AS i, substring(para, i, 50) AS x FROM e_p WHERE length(para) >= 50) gr JOIN bl ON bl.lang = gr.lang AND bl.x = gr.x) GROUP BY 1, 2, 3),
dp AS (SELECT lang, x FROM fb UNION SELECT lang, para FROM g_p JOIN pat USING (lang, para)),
ks AS (SELECT k.lang, count(*) AS len, sum(para_removed)::BIGINT AS num_dedup_para, sum(block_removed)::BIGINT AS num_dedup_block, round(avg((SELECT {SHARE} FROM documents d WHERE d.doc_id = k.doc_id)), 6) AS avg_lang_score, round(avg({SHARE}), 6) AS avg_dedup_after_lang_score, round(avg(paralen), 6) AS avg_paralen, round(avg(strlen(text) / orig_textlen), 6) AS avg_text_ret_rate FROM k GROUP BY k.lang)
SELECT tot.lang AS language, n0 AS orig_len, (SELECT count(*) FROM a WHERE a.lang = tot.lang) - (SELECT count(*) FROM s WHERE s.lang = tot.lang) AS num_sens, (SELECT string_agg(w, ',' ORDER BY w) FROM sw WHERE sw.lang = tot.lang) AS sens_patterns,
(SELECT count(*) FROM dp WHERE dp.lang = tot.lang) AS n_patterns, (SELECT md5(string_agg(x, chr(10) ORDER BY x)) FROM dp WHERE dp.lang = tot.lang) AS dedup_patterns_md5, coalesce(len, 0) AS len, coalesce(num_dedup_para, 0) AS num_dedup_para, coalesce(num_dedup_block, 0) AS num_dedup_block,
avg_lang_score, avg_dedup_after_lang_score, avg_paralen, avg_text_ret_rate FROM tot LEFT JOIN ks ON ks.lang = tot.lang""")
def group_patterns(spark, sf):
    """Statistics of the whole refinement with the texts of the patterns that were found and taken out."""
    own = documents(spark, sf).withColumn("lang_score", _shares(F.col("text"))["score"])
    steps = refine.rounds(own, lexicon.find_matches(F.col("text"), F.col("language"), tries()), BY_LANGUAGE, detector=_shares)
    out = refine.group_patterns(steps, BY_LANGUAGE)
    means = [F.round(c, 6).alias(c) for c in ("avg_lang_score", "avg_dedup_after_lang_score", "avg_paralen", "avg_text_ret_rate")]
    texts = [F.array_join("sens_patterns", ",").alias("sens_patterns"), F.coalesce(F.size("dedup_patterns"), F.lit(0)).cast("long").alias("n_patterns"), md5(F.array_join("dedup_patterns", "\n")).alias("dedup_patterns_md5")]
    return out.select("language", "orig_len", "num_sens", *texts, "len", "num_dedup_para", "num_dedup_block", *means)


@query(f"WITH RECURSIVE {PAIRS} SELECT a, b, distance FROM p")
def neardup_stream(spark, sf):
    """Near pairs found by a stream that reads a third of the documents' files at a time; there are as many files as the table has splits, three at least."""
    folder = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    own = table(spark, sf, "documents").select("doc_id", "text")
    files = max(3, own.rdd.getNumPartitions())
    own.repartition(files).write.parquet(f"{folder}/in")
    streamed.run(spark, f"{folder}/in", "doc_id long, text string", f"{folder}/out", files=-(-files // 3))
    hashes, found = spark.read.parquet(f"{folder}/out/hashes"), spark.read.schema(streamed.LINK).parquet(f"{folder}/out/links")
    return streamed.pairs(hashes, found)


@query("""WITH g AS (SELECT source, ceil(count(*) / 40) AS k FROM documents GROUP BY source), r AS (SELECT doc_id, source, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % k::BIGINT AS piece FROM documents JOIN g USING (source)),
p AS (SELECT source, piece, count(*) AS n FROM r GROUP BY 1, 2), f AS (SELECT source, piece, ((sum(n) OVER (ORDER BY source, piece) - n) // 40)::INTEGER AS file FROM p) SELECT doc_id, source AS domain, file FROM r JOIN f USING (source, piece)""")
def rolled_files(spark, sf):
    """Files of whole domains, about 40 rows each, written and read back; larger domains are in pieces."""
    folder = f"{shared_folder(spark).rstrip('/')}/rolled-{uuid.uuid4().hex}"
    salt = F.conv(F.substring(md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long")
    sinks.write_grouped(documents(spark, sf).select("doc_id", "domain"), folder, ["domain"], most=40, salt=salt)
    return spark.read.schema("doc_id long, domain string, file int").parquet(folder).select("doc_id", "domain", "file")


def _learnt() -> F.Column:
    """Whether a document is learnt from: four of five, by a hash of the id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0


@query()
def language_id(spark, sf):
    """Each document's language and score by a model of four of five documents."""
    own = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.train(own.filter(_learnt()))
    found = own.select("doc_id", (~_learnt()).alias("held_out"), F.col("lang").alias("labelled"), lang.detect(F.col("text"), model).alias("own"))
    return found.select("doc_id", "held_out", "labelled", F.col("own.lang").alias("lang"), F.round(F.col("own.score").cast("double"), 4).alias("score"))


CHARSETS = ("cp1252", "cp850", "mac_roman", "utf-16-be", "utf-16-le")


@query()
def charset_decode(spark, sf):
    """Documents in one of six charsets each, UTF-8 where one lacks a character, detected and read by a model of four of five documents."""
    own = table(spark, sf, "documents").select("doc_id", "text")
    model = charset.train(own.filter(_learnt()), CHARSETS)
    names = F.array(*(F.lit(c) for c in (*CHARSETS, "utf-8")))
    dealt = own.select("doc_id", "text", F.element_at(names, (F.pmod(F.crc32(F.reverse(F.col("doc_id").cast("string")).cast("binary")), F.lit(6)) + 1).cast("int")).alias("charset"))
    body = F.coalesce(charset.encoded(F.col("text"), F.col("charset")), F.col("text").cast("binary"))
    found = dealt.select("doc_id", (~_learnt()).alias("held_out"), "text", "charset", charset.decoded(body, model).alias("own"))
    return found.select("doc_id", "held_out", "charset", F.col("own.charset").alias("detected"), F.round("own.confidence", 4).alias("confidence"), F.col("own.text").eqNullSafe(F.col("text")).alias("same"))


#: Phrases that hold one another, each put into brackets.
PHRASES = ["schaft", "sch", "ch", "ation", "tion", "io", "ion", "que", "u", "the", "he", "e"]


@query(f"SELECT doc_id, md5(regexp_replace(text, '({'|'.join(sorted(PHRASES, key=len, reverse=True))})', '[\\1]', 'g')) AS text_md5 FROM documents")
def script_convert(spark, sf):
    """Leftmost-longest conversion by a table of phrases and characters."""
    own = table(spark, sf, "documents")
    return own.select("doc_id", md5(lang.converted(F.col("text"), {w: f"[{w}]" for w in PHRASES})).alias("text_md5"))
