"""Queries of the corpus operators, each with the SQL that yields the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.llm import (fingerprint, hardneg, interaction, language, maintext, neardup, packing, pieces, pseudonyms, quality,
                           substring, toxicity, warc)
from skywarden.llm.store import table

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Run, str | None]] = {}

# Key of the registered queries; a deployment brings its own secret.
PSEUDONYM_KEY = b"key of the registered queries"

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = (run, sql)
        return run
    return register


_NEAR_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
        THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.g = y.g AND x.doc_id > y.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * n_both >= 75 * (m.n + o.n - n_both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.a = d.doc_id"""


@query("op1_near_duplicates", _NEAR_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


_REPEATS_SQL = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws
           FROM documents),
s AS (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
h AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM s),
d AS (SELECT h FROM h GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM h SEMI JOIN d USING (h)),
g AS (SELECT r, list(i) AS gone FROM c GROUP BY 1),
k AS (SELECT doc_id, ws, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN ws ELSE list_select(ws, list_sort(list_filter(range(1, len(ws) + 1),
                                                             lambda i: NOT list_contains(gone, i)))) END AS kept
      FROM w LEFT JOIN g USING (r))
SELECT doc_id, len(ws) AS n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""


@query("op8_substring_dedup", _REPEATS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op6_pseudonyms")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymous(table(spark, sf_dir, "documents"), PSEUDONYM_KEY).select(
        "doc_id", "n_replaced", "text")


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


_QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
           FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS ws FROM d),
t AS (SELECT r, i, array_to_string(ws[i:i + 2], ' ') AS three
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
tr AS (SELECT r, count(DISTINCT p) AS n_repeat_words
       FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM t JOIN
             (SELECT r, three FROM t GROUP BY 1, 2 HAVING count(*) > 1) USING (r, three)) GROUP BY 1),
l0 AS (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT r, host, line, regexp_extract_all(line, '{WORD}') AS ws FROM l0),
ln AS (SELECT r, host, line, len(ws) AS n, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
              'abcdefghijklmnopqrstuvwxyz000000000') AS norm FROM l WHERE len(ws) > 0),
du AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln GROUP BY 1),
h AS (SELECT host, count(*) AS documents FROM d GROUP BY 1),
c AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT r) AS n_docs FROM ln GROUP BY 1, 2) JOIN h USING (host)
      WHERE n_docs > 20 AND 100 * n_docs > 2 * documents),
g AS (SELECT r, count(*) AS n_common_lines, sum(n)::BIGINT AS gone FROM ln SEMI JOIN c USING (host, norm) GROUP BY 1),
f AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_common_lines, 0) AS n_common_lines, len(ws) - coalesce(gone, 0) AS n_left_words
      FROM w LEFT JOIN tr USING (r) LEFT JOIN du USING (r) LEFT JOIN g USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 2 * n_left_words >= n_words AS kept FROM b"""


@query("op2_quality_rules", _QUALITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head
      FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM m"""


@query("op5_warc", _WARC_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, how many, and the digest of what they decode to."""
    decoded = pieces.encode(table(spark, sf_dir, "documents"), back=True)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
                          F.sha2("text", 256).alias("decoded_sha256"))


_HARD_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             list_inner_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.r <> c.r),
p AS (SELECT r, anchor_id, other_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS k
      FROM s WHERE same QUALIFY k <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same
      WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""


@query("op11_hard_negatives", _HARD_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


_AUDIT_SQL = rf"""
WITH j AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS ws, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
      FROM t),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text)
                     THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN e THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN j USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
      FROM d GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT part, fails, n, n_good, n_toxic, filter_order, unnest(range(1, 6))::INTEGER AS step,
             coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''),
                                              lambda f: instr(filter_order, f))), 6) AS gone
      FROM c, o),
r AS (SELECT part, filter_order, step, filter_order[step] AS f,
             coalesce(sum(n) FILTER (gone > step), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (gone = step), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (gone < step AND contains(fails, filter_order[step])), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (fails = filter_order[step]), 0)::BIGINT AS unique_fails,
             coalesce(sum(n_good) FILTER (gone = step), 0)::BIGINT AS good_lost,
             coalesce(sum(n_toxic) FILTER (gone = step), 0)::BIGINT AS toxic_lost
      FROM s GROUP BY 1, 2, 3)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r"""


@query("op12_filter_interactions", _AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# The given pages mark their article and have plain blocks in it; what the operator does beyond that is tested by hand.
_TEXT_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, list_transform(string_split(regexp_replace(x, '</?(?:p|h1)>', chr(1), 'g'), chr(1)), lambda s:
        trim(regexp_replace(regexp_replace(replace(s, '<br>', ' '), '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a),
t AS (SELECT page_id, url, regexp_replace(replace(replace(replace(
        array_to_string(list_filter(blocks, lambda s: s <> ''), chr(10) || chr(10)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
        '&amp;?', '&', 'g') AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t"""


@query("op13_main_text", _TEXT_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_texts(table(spark, sf_dir, "pages"))
