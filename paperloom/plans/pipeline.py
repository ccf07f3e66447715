"""The pipeline: pages -> responses -> questions -> documents."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, decode, dedup, extract, geometry, ingest, render
from ..sources import config as config_
from ..sources import files
from ..storage import stage


def process_documents(pages: DataFrame, load: Callable[[], Callable[[object, str], str]], timeout: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(questions, quarantine) of pages (exam_code, page_number, raster,
    width_px, height_px). Pages whose response fails to come or to decode are
    in the quarantine; a failing question ends its page (see
    ``dedup.survivors``). Exams are kept apart."""
    answered = stage(extract.with_responses(pages, "raster", load, timeout=timeout).select("exam_code", "page_number", "width_px", "height_px", "response", "error"), "responses")
    failed = answered.filter("response IS NULL").select("exam_code", "page_number", "response", "error")
    good, bad = decode.decode(answered.filter("response IS NOT NULL").drop("error"), "response")
    flat = decode.explode_questions(good, ["exam_code", "page_number", "width_px", "height_px"])
    # A falsy text is skipped unless the item fails before it is looked at.
    live = flat.filter("question_text <> '' OR failure = 'before'")
    text = clean.clean_text(F.col("question_text"))
    cleaned = stage(live.withColumn("question_text", F.coalesce(text, F.lit(""))), "questions")
    kept = dedup.survivors(cleaned, "exam_code", "page_number", "q_index", "question_text", "failure")
    box = lambda i: geometry.pixel_box(i["bbox"], F.col("width_px"), F.col("height_px"))
    images = F.transform("images", lambda i, k: F.struct(i["type"].alias("type"), i["description"].alias("description"), i["bbox"].alias("bbox"), F.when((box(i)["right"] > box(i)["left"]) & (box(i)["bottom"] > box(i)["top"]), geometry.figure_path(F.col("page_number"), F.col("q_index"), k)).alias("local_path"), box(i).alias("box")))
    questions = kept.withColumn("options", clean.clean_options(F.col("question_type"), F.col("options"))).withColumn("images", images)
    return questions.drop("failure", "width_px", "height_px"), bad.select("exam_code", "page_number", "response", "error").unionByName(failed)


def figures(questions: DataFrame, pages: DataFrame) -> DataFrame:
    """(exam_code, local_path, png) of the questions' figures. ``local_path``
    is relative to the exam's own folder."""
    each = questions.select("exam_code", "page_number", F.inline("images")).filter("local_path IS NOT NULL")
    j = each.join(pages.select("exam_code", "page_number", "raster", "width_px", "height_px"), ["exam_code", "page_number"])
    png = extract.crop_png("raster", "width_px", "height_px", "box.left", "box.top", "box.right", "box.bottom")
    return j.select("exam_code", "local_path", png.alias("png"))


def document_parts(exams: DataFrame, numbered: DataFrame, kind: str, parity_html: bool = False) -> DataFrame:
    """(exam_code, ord, part): 'md' or 'html' of all exams, those without
    questions included, in parts that joined in order are the document."""
    cols = [F.col(c) for c in ("ordinal", "question_type", "correct_answer", "metadata", "question_text", "images", "tables", "options")]
    if kind == "md":
        head, none, tail, between = F.concat(F.lit("# Exam Questions ("), F.col("exam_code"), F.lit(")\n\n")), F.lit("No questions found.\n"), F.lit(""), "\n"
        part = render.markdown_question(*cols)
    else:
        head, tail, between = render.html_head(F.col("exam_code"), parity_html=parity_html), F.lit(render.HTML_TAIL), "\n"
        none = F.lit('<p style="text-align:center; color:#94a3b8;">No questions found in this output.</p>')
        part = render.html_card(*cols, parity_html=parity_html)
    return render.in_parts(exams, numbered.select("exam_code", "ordinal", part.alias("part")), head, none, tail, between)


def text_of_pages(source: DataFrame, pages: DataFrame, parser: Callable | None) -> DataFrame:
    """Adds ``raw_text`` and ``blocks`` to pages: '' and an empty list without
    a parser, for files it can't read and for failed pages."""
    if parser is None:
        return pages.withColumns({"raw_text": F.lit(""), "blocks": F.array().cast("array<string>")})
    elements = stage(files.text_layer(source, parser), "elements")
    keys = pages.select("exam_code", "page_number")
    found = ingest.page_text(keys, elements).select("exam_code", "page_number", F.col("page_text").alias("raw_text")).join(ingest.page_blocks(keys, elements), ["exam_code", "page_number"])
    return ingest.mark_failed(pages.join(found, ["exam_code", "page_number"], "left"), "raw_text", "blocks")


def write_documents(exams: DataFrame, numbered: DataFrame, output: str, parity_html: bool = False) -> None:
    """<exam>/<exam>.md and .html below ``output``."""
    for kind in ("md", "html"):
        name = F.concat("exam_code", F.lit("/"), "exam_code", F.lit(f".{kind}"))
        files.write_in_order(document_parts(exams, numbered, kind, parity_html).select(name.alias("name"), "ord", "part"), output)


def render_written(spark: SparkSession, documents: str, output: str, parity_html: bool = False) -> None:
    """Documents of JSON results that were written before (a glob or folder)."""
    bodies = files.read_documents(spark, documents)
    q = decode.explode_questions(decode.decode_marked(bodies, "body").filter("body IS NOT NULL").select("exam_code", "body"), ["exam_code"])
    known = F.from_json("raw", "images array<struct<type string, description string, local_path string>>")["images"]
    numbered = q.select("*", (F.col("q_index") + 1).alias("ordinal")).withColumn("images", known)
    write_documents(bodies.select("exam_code"), stage(numbered, "written"), output, parity_html)


def run(spark: SparkSession, load: Callable, renderers: list[Callable], input: str | None = None, folder: str | None = None, exam_code: str | None = None, output: str | None = None, skip_render: bool = False, config: dict[str, Any] | str | None = None, parser: Callable | None = None, debug: bool = False, parity_html: bool = False) -> dict[str, Any]:
    """Files to documents. One ``input`` file or all files of ``folder``;
    ``exam_code`` names the exam of a single file. ``config``: a dictionary or
    a file. Returns the DataFrames and the counts of pages and questions;
    writes below <output>/<exam> if ``output`` is given, and the rasters of
    all pages with ``debug``.

    With ``fail_on_parse_error`` a file of which no page was read raises where
    it is the single input; of a folder only that file is left out
    (``failed_files``).
    """
    config = config_.load_config(config) if isinstance(config, str) else config or {}
    if folder and exam_code:
        raise ValueError("exam_code is for a single file: all outputs would share a name")
    if not input and not folder:
        raise ValueError("give an input file or a folder")
    source = files.scan_directory(spark, folder) if folder else files.scan_file(spark, input, exam_code)
    own = config.get("ingest") or {}
    raw = stage(files.rasterise(source, renderers, own.get("dpi", 300), own.get("page_timeout_seconds", 30)), "pages")
    stats = stage(ingest.ingest_stats(raw), "ingest")
    failed = ingest.check_documents(stats, bool(own.get("fail_on_parse_error")) and not folder).select("exam_code")
    pages = text_of_pages(source, raw.filter("page_number IS NOT NULL"), parser)
    exams = stats.select("exam_code")
    if own.get("fail_on_parse_error"):
        exams = exams.join(failed, "exam_code", "left_anti")
    # Failed pages that have a raster are sent to the extractor like others.
    questions, quarantine = process_documents(raw.filter("raster IS NOT NULL"), load, own.get("extract_timeout_seconds"))
    questions = stage(questions, "result")
    out = {"pages": pages, "stats": stats, "failed_files": failed, "questions": questions, "quarantine": quarantine, "n_pages": raw.filter("NOT parse_failed").count(), "n_questions": questions.count()}
    if debug and output:
        files.write_files(extract.debug_rasters(raw), output, "name", "png")
    numbered = stage(render.with_ordinals(questions), "numbered")
    if not skip_render:
        out["md"], out["html"] = (document_parts(exams, numbered, kind, parity_html) for kind in ("md", "html"))
    if output:
        name = F.concat("exam_code", F.lit("/"), "exam_code", F.lit(".json")).alias("name")
        files.write_in_order(files.document_parts(exams, numbered).select(name, "ord", "part"), output)
        files.write_files(figures(questions, raw).select(F.concat("exam_code", F.lit("/"), "local_path").alias("name"), "png"), output, "name", "png")
        if not skip_render:
            write_documents(exams, numbered, output, parity_html)
    return out
