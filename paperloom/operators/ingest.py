"""Page tables: page text from layout elements, failed pages, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_scan(pages: DataFrame, columns: list[str]) -> DataFrame:
    """One row per exam and page: the latest scan (ties: larger uid), with the
    given columns. Only they and the order are read and shuffled."""
    best = F.max_by(F.struct(*columns), F.struct("scanned_at", "page_uid")).alias("_r")
    return pages.groupBy("exam_code", "page_number").agg(best).select("exam_code", "page_number", *[F.col(f"_r.{c}").alias(c) for c in columns])


def page_text(pages: DataFrame, elements: DataFrame) -> DataFrame:
    """(exam_code, page_number, page_text, n_blocks): the truthy element texts
    of a page in document order; '' and 0 for pages without elements.
    elements: (exam_code, page_number, ord, text)."""
    texts = F.when(F.col("text") != "", F.struct("ord", "text"))
    per = elements.groupBy("exam_code", "page_number").agg(F.sort_array(F.collect_list(texts)).alias("t"), F.count("*").cast("int").alias("n"))
    per = per.select("exam_code", "page_number", F.array_join(F.col("t.text"), "\n").alias("t"), "n")
    joined = pages.select("exam_code", "page_number").distinct().join(per, ["exam_code", "page_number"], "left")
    return joined.select("exam_code", "page_number", F.coalesce("t", F.lit("")).alias("page_text"), F.coalesce("n", F.lit(0)).alias("n_blocks"))


def page_blocks(pages: DataFrame, elements: DataFrame) -> DataFrame:
    """(exam_code, page_number, blocks): the labels of all elements of a page
    in document order; an empty list for pages without elements."""
    per = elements.groupBy("exam_code", "page_number").agg(F.sort_array(F.collect_list(F.struct("ord", "label")))["label"].alias("b"))
    joined = pages.select("exam_code", "page_number").distinct().join(per, ["exam_code", "page_number"], "left")
    return joined.select("exam_code", "page_number", F.coalesce("b", F.array().cast("array<string>")).alias("blocks"))


def mark_failed(pages: DataFrame, text: str = "raw_text", blocks: str = "docling_blocks") -> DataFrame:
    """Failed pages keep their raster size but have no text and no blocks."""
    failed = F.coalesce("parse_failed", F.lit(False))
    none = F.array().cast("array<string>")
    return pages.withColumns({text: F.when(failed, "").otherwise(F.coalesce(text, F.lit(""))), blocks: F.when(failed, none).otherwise(F.coalesce(blocks, none)), "parse_failed": failed})


def ingest_stats(pages: DataFrame) -> DataFrame:
    failed = F.coalesce("parse_failed", F.lit(False))
    return pages.groupBy("exam_code").agg(F.count_if(~failed).alias("n_ok"), F.count("*").alias("n_total"), F.count_if(failed).alias("n_failed"), F.bool_and(failed).alias("all_failed"))


def check_documents(stats: DataFrame, fail_on_parse_error: bool = False) -> DataFrame:
    """Exams of which no page was read; raises if asked to and there are any."""
    bad = stats.filter("all_failed")
    if fail_on_parse_error and (first := bad.head(1)):
        raise RuntimeError(f"zero pages parsed from {first[0]['exam_code']}")
    return bad
