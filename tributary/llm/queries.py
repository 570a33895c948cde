"""Queries over the shared test tables, and the SQL they agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tributary.llm import bpe, contamination, conversations, covertree, jaccard, language, licenses, lines
from tributary.llm import negatives, quality, secrets, toxicity, warc
from tributary.llm.common import LOWER, UPPER, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan_secrets(documents, model=secrets.learnt_model(documents)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "lines_removed", "words_removed", "text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return contamination.digest(contamination.find_contamination(documents, benchmark))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_pages(warc.normalise_archives(archives)).drop("url")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.score_documents(documents, toxicity.fit(documents, labels))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by all evidence, and documents by their text and source; one id of a row is null."""
    documents, pages = (table(spark, sf_dir, name) for name in ("documents", "pages"))
    model = language.fit(documents)
    of_pages = language.identify(pages, model, "page_id", "html", "url", markup=True)
    of_documents = language.identify(documents, model, "doc_id", "text", "source", markup=False)
    no_id = F.lit(None).cast("long")
    return (
        of_documents.withColumnRenamed("id", "doc_id")
        .withColumn("page_id", no_id)
        .unionByName(of_pages.withColumnRenamed("id", "page_id").withColumn("doc_id", no_id))
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "component_size")


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.audit_conversations(rows, conversations.damage(rows))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth row is an anchor; every seventh row is given the next label first."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_secret_scans,
        op2_line_dedup,
        op3_decontamination,
        op4_warc,
        op5_quality_rules,
        op6_license_scans,
        op7_toxicity,
        op8_language_id,
        op9_bpe,
        op10_jaccard_join,
        op11_embedding_near_dedup,
        op12_conversation_repair,
        op13_hard_negatives,
    )
}
# Words of texts with A-Z lowered, as the contracts take them.
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PARTS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op3_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT item_id, w, s, least(13, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
grams AS (SELECT DISTINCT k, array_to_string(w[s:s + k - 1], ' ') AS g, item_id FROM wins),
sizes AS (SELECT DISTINCT k FROM wins),
places AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docs, sizes WHERE len(w) >= k),
found AS (
  SELECT doc_id, s, p.k, item_id FROM places p JOIN grams g ON p.k = g.k AND array_to_string(w[s:s + p.k - 1], ' ') = g.g),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id),
item_terms AS (SELECT item_id, w, unnest(w) AS term, unnest(range(0, len(w))) AS place FROM items),
postings AS (
  SELECT doc_id, term, position FROM (
    SELECT doc_id, unnest(w) AS term, unnest(range(0, len(w))) AS position FROM docs)
  WHERE term IN (SELECT term FROM item_terms)),
counts AS (SELECT term, count(*) AS n FROM postings GROUP BY term),
counted AS (
  SELECT x.item_id, x.w, x.place, x.term, coalesce(c.n, 0) AS n FROM item_terms x LEFT JOIN counts c USING (term)),
ranked AS (
  SELECT v.item_id, v.w, v.s, c.place, c.term, row_number() OVER (PARTITION BY v.item_id, v.w, v.s ORDER BY c.n, c.place) AS r,
    min(c.n) OVER (PARTITION BY v.item_id, v.w, v.s) AS least_n, least(2, v.k) AS lists
  FROM wins v JOIN counted c ON v.item_id = c.item_id AND v.w = c.w AND c.place BETWEEN v.s - 1 AND v.s + v.k - 2),
rarest AS (SELECT * FROM ranked WHERE r <= 2 AND least_n > 0),
shifted AS (
  SELECT DISTINCT p.doc_id, x.item_id, x.w, x.place, unnest([floor((p.position - x.place) / 8), floor((p.position - x.place) / 8) + 1]) AS stretch
  FROM (SELECT DISTINCT item_id, w, place, term FROM rarest) x JOIN postings p USING (term)),
near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (
    SELECT h.doc_id, h.item_id, x.w, x.s, h.stretch FROM shifted h JOIN rarest x ON h.item_id = x.item_id AND h.w = x.w AND h.place = x.place
    GROUP BY ALL HAVING count(DISTINCT h.place) = max(x.lists))
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS latest, sha1(h) AS hex FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    list_sum([(strpos('0123456789abcdef', substr(hex, (i // 4) * 5 + j + 1, 1)) - 1) * CAST(pow(16, 4 - j) AS BIGINT) for j in range(0, 5)])
    // CAST(pow(32, 3 - i % 4) AS BIGINT) % 32 AS BIGINT) + 1, 1) for i in range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = latest THEN NULL ELSE latest END AS refers_to
FROM m
""",
    "op5_quality_rules": f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t, {_PARTS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
each_line AS (
  SELECT doc_id, source, line, {_PARTS.format(f"translate(line, '{UPPER}', '{LOWER}')")} AS lw
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM docs)),
worded AS (SELECT doc_id, source, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM each_line WHERE len(lw) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT doc_id) AS documents FROM docs GROUP BY source),
frequent AS (
  SELECT source, norm FROM worded JOIN hosts USING (source) GROUP BY source, norm, documents
  HAVING count(DISTINCT doc_id) > 8 AND count(DISTINCT doc_id) > documents * 0.1),
removed AS (SELECT doc_id, sum(n) AS words_removed FROM worded JOIN frequent USING (source, norm) GROUP BY doc_id),
rows AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(words_removed, 0) AS words_removed
  FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM rows)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  CAST(words_removed AS BIGINT) AS words_removed, base_failed,
  NOT base_failed AND NOT (words_removed > 0 AND (n_words - words_removed < 10 OR n_words - words_removed < n_words * 0.5)) AS kept
FROM judged
""",
    "op10_jaccard_join": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_PARTS.format(_LOWERED)} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id, count(*) AS component_size
FROM docs d JOIN reach ON d.doc_id = a LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
""",
    "op11_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
}
