"""Queries pN_ of the text problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import abuse, copies, nearcopies, packing, scan_repair, tokenise

CAPACITY = 2_048


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    classes = copies.copy_classes(_read(spark, d, "questions"), "question_uid", "question_text", "options")
    return classes.filter("question_uid <> first").select(F.col("first").alias("first_uid"), F.col("question_uid").alias("copy_uid"))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Each question that occurs in several records, once."""
    classes = copies.copy_classes(_read(spark, d, "questions"), "question_uid", "question_text", "options")
    return classes.filter("question_uid = first").select(F.col("first").alias("first_uid"), F.col("n").alias("n_records"))


def _elements(q: DataFrame) -> DataFrame:
    return nearcopies.question_elements(q, "question_uid", "question_text", "options", width=3)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nearcopies.similar_pairs(_read(spark, d, "questions"), _elements, threshold=0.5)


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each record that has a similar one, with its group: the connected
    component of the pairs."""
    return nearcopies.similar_groups(_read(spark, d, "questions"), _elements, threshold=0.5, key="question_uid")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = scan_repair.repairs(_read(spark, d, "page_documents"), _read(spark, d, "classified_blocks"))
    return found.select(F.col("kind").alias("record_kind"), F.col("id").alias("record_id"), "line_no", "noise_kind", "repaired").distinct()


def p6_text(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.paragraphs(_read(spark, d, "page_documents"), _read(spark, d, "classified_blocks"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenise.encode_texts(_read(spark, d, "documents"), "doc_id", "text")


def p8_bins(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_texts(_read(spark, d, "documents"), "doc_id", "text", CAPACITY)


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and the share of the capacity that is used."""
    rows = packing.pack_texts(_read(spark, d, "documents"), "doc_id", "text", CAPACITY)
    fill = rows.filter("bin_id IS NOT NULL").groupBy("bin_id").agg(F.sum("n_tokens").alias("n"))
    return fill.agg(F.count("*").alias("n_bins"), F.sum("n").alias("n_tokens"), (F.sum("n") / (F.count("*") * CAPACITY)).alias("used"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).filter("score >= 0.5").select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    documents = _read(spark, d, "documents")
    model = abuse.fit(documents, _read(spark, d, "labels"))
    return abuse.score_documents(documents, model, keep=("source",))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """Documents, documents found and their share, for each source."""
    found = F.count_if(F.col("score") >= 0.5)
    return p9_scores(spark, d).groupBy("source").agg(F.count("*").alias("n_docs"), found.alias("n_found"), (found / F.count("*")).alias("rate"))


QUERIES = {f.__name__: f for f in (p2_found, p2_counts, p4_found, p4_groups, p6_found, p6_text, p7_ids, p8_bins, p8_report, p9_found, p9_scores, p9_rates)}

_P2 = r"""
WITH n AS (SELECT question_uid AS u, regexp_replace(lower(question_text), '[^\p{L}\p{M}\p{N}]+', '', 'g') AS t,
  array_to_string(list_sort(list_filter(list_transform(coalesce(options, []), lambda o: regexp_replace(lower(o), '[^\p{L}\p{M}\p{N}]+', '', 'g')), lambda o: o IS NOT NULL AND o <> '')), chr(10)) AS o
  FROM questions WHERE regexp_matches(question_text, '[\p{L}\p{N}]')),
c AS (SELECT t, o, min(u) AS first_uid, count(*) AS n FROM n GROUP BY t, o HAVING count(*) > 1)
"""

_P4 = r"""
WITH RECURSIVE q AS (SELECT question_uid AS u, regexp_extract_all(lower(question_text), '[\p{L}\p{M}\p{N}]+') AS w, coalesce(options, []) AS opts,
  regexp_replace(lower(question_text), '[^\p{L}\p{M}\p{N}]+', '', 'g') || chr(10) ||
  array_to_string(list_sort(list_filter(list_transform(coalesce(options, []), lambda o: regexp_replace(lower(o), '[^\p{L}\p{M}\p{N}]+', '', 'g')), lambda o: o IS NOT NULL AND o <> '')), chr(10)) AS d
  FROM questions WHERE regexp_matches(question_text, '[\p{L}\p{N}]')),
e AS (SELECT DISTINCT u, 't' || w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM q, unnest(range(1, len(w) - 1)) AS r(i)
  UNION SELECT DISTINCT u, 'o' || array_to_string(regexp_extract_all(lower(o), '[\p{L}\p{M}\p{N}]+'), ' ') FROM q, unnest(opts) AS r(o)
  WHERE regexp_matches(o, '[\p{L}\p{N}]')),
s AS (SELECT u, count(*) AS n FROM e GROUP BY u),
p AS (SELECT a.u AS ua, b.u AS ub, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.u < b.u GROUP BY 1, 2),
found AS (SELECT ua AS uid_a, ub AS uid_b FROM p JOIN s sa ON sa.u = ua JOIN s sb ON sb.u = ub JOIN q qa ON qa.u = ua JOIN q qb ON qb.u = ub
WHERE c >= 0.5 * (sa.n + sb.n - c) AND qa.d <> qb.d)
"""

ORACLE = {
    "p2_found": _P2 + "SELECT first_uid, u AS copy_uid FROM n JOIN c USING (t, o) WHERE u <> first_uid",
    "p2_counts": _P2 + "SELECT first_uid, n AS n_records FROM c",
    "p4_found": _P4 + "SELECT uid_a, uid_b FROM found",
    "p4_groups": _P4.rstrip()
    + """, links AS (SELECT uid_a AS a, uid_b AS b FROM found UNION SELECT uid_b, uid_a FROM found),
reach AS (SELECT DISTINCT a AS u, a AS r FROM links UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.u),
g AS (SELECT u, min(r) AS group_uid FROM reach GROUP BY u)
SELECT u AS question_uid, group_uid, count(*) OVER (PARTITION BY group_uid) AS n_records FROM g""",
}
