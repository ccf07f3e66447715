"""Typed views that the document schema intends: block classes, question
boundaries, validation, review flags, provenance, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classify_block(text: Column) -> Column:
    """A tag from the shape of a block's text."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(~t.rlike(r"\S"), "unknown")
        .when(t.rlike(r"(?i)^\s*question (number|id)\s*:"), "question_header")
        .when(t.rlike(r"\$[^$]+\$"), "math_inline")
        .when(t.rlike(r"(?m)^\s*\|.*\|\s*$"), "table")
        .when(t.rlike(r"(?m)^\s*(\d+|[A-H])[.)]\s+\S"), "option_block")
        .when(t.rlike(r"\?\s*$"), "question_text")
        .otherwise("text")
    )


def question_runs(blocks: DataFrame, exam: str, order: str, is_header: Column) -> DataFrame:
    """Adds ``run``: the number of headers so far in the page (0 before the
    first), for grouping blocks by question. Windows hold a page each."""
    w = Window.partitionBy(exam, "page_number").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("run", F.sum(is_header.cast("int")).over(w).cast("int"))


def issues(text: Column, options: Column, tables: Column) -> Column:
    """Names of the checks a question fails, sorted by name."""
    t = F.coalesce(text, F.lit(""))
    ragged = F.exists(F.coalesce(tables, F.array()), lambda x: F.exists(F.coalesce(x["rows"], F.array().cast("array<array<string>>")), lambda r: F.size(r) != F.size(x["headers"])))
    checks = [
        ("braces", F.regexp_count(t, F.lit(r"\{")) != F.regexp_count(t, F.lit(r"\}"))),
        ("dollars", F.regexp_count(t, F.lit(r"\$")) % 2 == 1),
        ("no_text", ~t.rlike(r"\S")),
        ("options", F.coalesce(F.size(options), F.lit(0)) > 8),
        ("ragged_table", F.coalesce(ragged, F.lit(False))),
    ]
    return F.concat_ws(",", *[F.when(c, n) for n, c in checks])


def page_ends(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds ``first_line`` and ``last_line``: the outer lines of a page that
    aren't blank, null for pages without any; all that stitching needs."""
    first, last = F.regexp_extract(text, r"^\s*(\S[^\n]*)", 1), F.regexp_extract(text, r"([^\n]*\S)\s*\z", 1)
    return pages.withColumns({"first_line": F.nullif(first, F.lit("")), "last_line": F.nullif(last, F.lit(""))})


def continued(pages: DataFrame, exam: str = "exam_code", page: str = "page_number") -> DataFrame:
    """(exam, page, next_page, stitched): pages whose last character ends no
    sentence, the page they go on, and the line that runs over the break. An
    equi-join on the next page number; no window per exam."""
    open_ = pages.filter(F.col("last_line").rlike(r"[^.?!:;\s]\s*\z")).select(exam, page, (F.col(page) + 1).alias("next_page"), "last_line")
    nxt = pages.filter("first_line IS NOT NULL").select(F.col(exam), F.col(page).alias("next_page"), "first_line")
    joined = open_.join(nxt, [exam, "next_page"])
    return joined.select(exam, page, "next_page", F.concat(F.rtrim("last_line"), F.lit(" "), F.ltrim("first_line")).alias("stitched"))


def provenance(questions: DataFrame, exam: str = "exam_code") -> DataFrame:
    """One row of counters per exam, and a digest of its question ids that
    doesn't depend on their order."""
    q = F.col
    return questions.groupBy(exam).agg(
        F.count("*").alias("n_questions"), F.count_if(q("question_id").isNull()).alias("n_without_id"), F.count_if(~F.coalesce(q("question_text"), F.lit("")).rlike(r"\S")).alias("n_without_text"),
        F.count_if(q("correct_answer").isNull()).alias("n_without_answer"), F.count_if(F.size("images") > 0).alias("n_with_images"), F.count_if(F.size("tables") > 0).alias("n_with_tables"),
        F.bit_xor(F.conv(F.substring(F.sha2(q("question_uid").cast("string"), 256), 1, 15), 16, 10).cast("bigint")).alias("digest"),
    )
