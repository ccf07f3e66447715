"""Queries over the exam tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators import clean, decode, dedup, geometry, grade, ingest, render, views
from . import pipeline


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def clean_questions(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions").filter("question_text <> ''")
    return q.select("question_uid", "exam_code", "page_number", "q_index", clean.clean_text(F.col("question_text")).alias("clean_text"))


def clean_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_wins(clean_questions(spark, d), ["exam_code", "clean_text"], ["page_number", "q_index", "question_uid"])


def question_counts(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions").filter("question_text <> ''")
    rows = q.select("exam_code", clean.clean_text(F.col("question_text")).alias("clean_text"), "page_number", "q_index", "question_uid", clean.branch_type(F.col("question_type")).alias("type"))
    kept = dedup.first_wins(rows, ["exam_code", "clean_text"], ["page_number", "q_index", "question_uid"])
    return kept.groupBy("exam_code", "type").agg(F.count("*").alias("n_questions"))


def options_clean(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions")
    return q.select("question_uid", F.posexplode(clean.clean_options(F.col("question_type"), F.col("options"))).alias("pos", "option"))


def bbox_pixels(spark: SparkSession, d: str) -> DataFrame:
    sizes = ingest.latest_scan(_read(spark, d, "page_documents"), ["width_px", "height_px"])
    each = _read(spark, d, "questions").select("question_uid", "exam_code", "page_number", "q_index", F.posexplode("images").alias("img", "i"))
    j = each.join(sizes, ["exam_code", "page_number"])
    box = geometry.pixel_box(F.col("i.bbox"), F.col("width_px"), F.col("height_px"))
    return j.select("question_uid", "img", box.alias("b"), geometry.figure_path(F.col("page_number"), F.col("q_index"), F.col("img")).alias("local_path")).filter("b IS NOT NULL").select("question_uid", "img", "b.*", "local_path")


def page_text_agg(spark: SparkSession, d: str) -> DataFrame:
    blocks = _read(spark, d, "classified_blocks").select("exam_code", "page_number", F.col("block_index").alias("ord"), F.col("raw_text").alias("text"))
    return ingest.page_text(_read(spark, d, "page_documents"), blocks)


def ingest_stats(spark: SparkSession, d: str) -> DataFrame:
    return ingest.ingest_stats(_read(spark, d, "page_documents"))


def failed_pages(spark: SparkSession, d: str) -> DataFrame:
    failed, n = F.coalesce("parse_failed", F.lit(False)), lambda c: F.when(F.col("parse_failed"), 0).otherwise(F.coalesce(c, F.lit(0)))
    sizes = _read(spark, d, "page_documents").withColumns({"n_chars": n(F.length("raw_text")), "n_blocks": n(F.when(F.col("docling_blocks").isNotNull(), F.size("docling_blocks"))), "parse_failed": failed})
    return ingest.latest_scan(sizes, ["page_uid", "n_chars", "n_blocks", "parse_failed"])


def answer_keys(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "questions").select("question_uid", grade.answer_key(F.col("correct_answer")).alias("answer_key"))


def _marks(q: DataFrame) -> DataFrame:
    m = lambda k: F.try_element_at("metadata", F.lit(k))
    c, n = grade.leading_number(m("Correct Marks"), 1.0), grade.leading_number(m("Negative Marks"), 0.0)
    return q.select("question_uid", "exam_code", grade.answer_key(F.col("correct_answer")).alias("answer_key"), c.alias("c_marks"), n.alias("n_marks"))


def marks_parse(spark: SparkSession, d: str) -> DataFrame:
    return _marks(_read(spark, d, "questions")).select("question_uid", "c_marks", "n_marks")


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """Each event selects a label (or none) of the question of its number."""
    k = F.get_json_object("props", "$.k").cast("int")
    return _read(spark, d, "events").select("event_id", "user_id", F.col("event_id").alias("question_uid"), F.when(k % 5 < 4, F.char(k % 5 + 65)).otherwise("").alias("selected"))


def grade_status(spark: SparkSession, d: str) -> DataFrame:
    rows = grade.graded(_responses(spark, d), _marks(_read(spark, d, "questions")), "question_uid")
    return rows.select("event_id", "question_uid", "status", "score")


def grade_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = grade.graded(_responses(spark, d), _marks(_read(spark, d, "questions")), "question_uid")
    return grade.totals(rows, ["user_id"]).withColumn("score", F.round("score", 6))


def grade_shown(spark: SparkSession, d: str) -> DataFrame:
    """Totals as they are shown, with two decimals."""
    rows = grade.graded(_responses(spark, d), _marks(_read(spark, d, "questions")), "question_uid")
    return grade.totals(rows, ["user_id"]).select("user_id", F.format_string("%.2f", "score").alias("shown"))


def _clicks(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return _read(spark, d, "events").select("user_id", (F.col("event_id") % 20).alias("q_no"), F.char(k % 4 + 65).alias("label"), "ts", F.col("event_id").alias("seq"))


def msq_toggle(spark: SparkSession, d: str) -> DataFrame:
    return grade.toggled(_clicks(spark, d), ["user_id", "q_no"])


def mcq_last_click(spark: SparkSession, d: str) -> DataFrame:
    return grade.last_click(_clicks(spark, d), ["user_id", "q_no"])


def deadline_filter(spark: SparkSession, d: str) -> DataFrame:
    return grade.within_deadline(_read(spark, d, "events"), "user_id", "ts").select("event_id", "user_id")


def json_decode(spark: SparkSession, d: str) -> DataFrame:
    """Events' props as extractor responses: whole, with trailing text, with
    single quotes, fenced, and with a bare fence."""
    n = F.col("event_id") % 5
    text = F.when(n == 0, F.col("props")).when(n == 1, F.concat("props", F.lit(" done"))).when(n == 2, F.replace("props", F.lit('"'), F.lit("'"))).when(n == 3, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(F.concat(F.lit("```\n"), "props", F.lit("\n```")))
    marked = decode.decode_marked(_read(spark, d, "events").select("event_id", text.alias("response")), "response")
    return marked.select("event_id", F.get_json_object("body", "$.k").cast("int").alias("k"), F.col("body").isNull().alias("quarantined"))


def page_fail_fold(spark: SparkSession, d: str) -> DataFrame:
    """Questions kept where a null type fails 'after' and a blank id 'before'
    its text counts as seen."""
    q = _read(spark, d, "questions").filter("question_text <> ''")
    failure = F.when(F.col("question_id").isNull(), "before").when(F.col("question_type").isNull(), "after")
    rows = q.select("exam_code", "page_number", (F.col("q_index") * F.lit(1 << 40) + F.col("question_uid")).alias("at"), clean.clean_text(F.col("question_text")).alias("clean_text"), failure.alias("failure"), "question_uid")
    return dedup.survivors(rows, "exam_code", "page_number", "at", "clean_text", "failure").select("question_uid", "clean_text")


def _documents(spark: SparkSession, d: str) -> tuple[DataFrame, list]:
    q = _read(spark, d, "questions").filter("question_text <> ''").withColumn("question_text", clean.clean_text(F.col("question_text")))
    kept = dedup.first_wins(q.filter("page_number IS NOT NULL AND exam_code IS NOT NULL"), ["exam_code", "question_text"], ["page_number", "q_index", "question_uid"])
    kept = kept.withColumn("options", clean.clean_options(F.col("question_type"), F.col("options"))).withColumn("_at", F.struct("q_index", "question_uid"))
    images = F.transform(F.array_compact("images"), lambda i, k: F.struct(i["type"].alias("type"), i["description"].alias("description"), F.when(F.size(i["bbox"]) == 4, geometry.figure_path(F.col("page_number"), F.col("q_index"), k)).alias("local_path")))
    numbered = render.with_ordinals(kept.withColumn("images", images), index="_at")
    return numbered, [F.col(c) for c in ("ordinal", "question_type", "correct_answer", "metadata", "question_text", "images", "tables", "options")]


def markdown_questions(spark: SparkSession, d: str) -> DataFrame:
    numbered, cols = _documents(spark, d)
    return numbered.select("exam_code", "ordinal", render.markdown_question(*cols).alias("md"))


def html_questions(spark: SparkSession, d: str) -> DataFrame:
    numbered, cols = _documents(spark, d)
    return numbered.select("exam_code", "ordinal", render.html_card(*cols).alias("html"))


def exam_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The documents of all exams of the exam list, in parts in order."""
    numbered, _ = _documents(spark, d)
    return pipeline.document_parts(_read(spark, d, "exams").select("exam_code"), numbered, "md").filter("part <> ''")


def empty_exams(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions").filter("question_text <> ''").select("exam_code")
    return _read(spark, d, "exams").select("exam_code").join(q, "exam_code", "left_anti")


def comprehension_children(spark: SparkSession, d: str) -> DataFrame:
    g = _read(spark, d, "question_groups")
    child = g.filter("parent_comprehension_id IS NOT NULL").select("group_id", "exam_code", F.col("parent_comprehension_id").alias("question_id"))
    parent = g.filter("question_id IS NOT NULL").groupBy("exam_code", "question_id").agg(F.min("group_id").alias("parent_group"))
    return child.join(parent, ["exam_code", "question_id"], "left").select("group_id", "parent_group")


def group_blocks(spark: SparkSession, d: str) -> DataFrame:
    g = _read(spark, d, "question_groups").select("group_id", "exam_code", F.posexplode("block_indices").alias("pos", "block_index"))
    b = _read(spark, d, "classified_blocks").select("exam_code", "block_index", "block_id", "block_type")
    return g.join(b, ["exam_code", "block_index"], "left").select("group_id", "pos", "block_id", "block_type")


def block_classes(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "classified_blocks").select("block_id", views.classify_block(F.col("raw_text")).alias("tag"))


def question_runs(spark: SparkSession, d: str) -> DataFrame:
    b = _read(spark, d, "classified_blocks")
    return views.question_runs(b, "exam_code", "block_index", F.coalesce(F.col("block_type") == "question_text", F.lit(False))).select("block_id", "run")


def validation_issues(spark: SparkSession, d: str) -> DataFrame:
    q = _read(spark, d, "questions")
    return q.select("question_uid", views.issues(F.col("question_text"), F.col("options"), F.col("tables")).alias("issues"))


def section_rollup(spark: SparkSession, d: str) -> DataFrame:
    g = _read(spark, d, "question_groups")
    return g.groupBy("exam_code", "section_id").agg(F.count("*").alias("n_questions"), F.count_if(F.col("is_comprehension")).alias("n_comprehension"), F.min("start_page").alias("first_page"), F.max("end_page").alias("last_page"))


def provenance(spark: SparkSession, d: str) -> DataFrame:
    return views.provenance(_read(spark, d, "questions")).drop("digest")


def page_continuations(spark: SparkSession, d: str) -> DataFrame:
    ends = views.page_ends(_read(spark, d, "page_documents"))
    return views.continued(ingest.latest_scan(ends, ["last_line", "first_line"]))


def review_flags(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = _read(spark, d, "documents").select("doc_id", "source"), _read(spark, d, "labels")
    low = labels.groupBy("doc_id").agg(F.min("quality").alias("q"))
    return docs.join(low, "doc_id", "left").groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("q") <= 2).alias("n_review"), F.count_if(F.col("q").isNull()).alias("n_unlabelled"))


def short_answers(spark: SparkSession, d: str) -> DataFrame:
    """Line quantities against an expected range, set or value."""
    n = F.col("l_linenumber") % 3
    kind = F.when(n == 0, "Range").when(n == 1, "Set").otherwise("Equal")
    expected = F.array(F.lit("5"), F.lit("7"), F.lit("11"))
    match = grade.short_answer(kind, F.col("l_quantity").cast("int").cast("string"), expected, F.lit(10.0), F.lit(20.0), F.lit(True))
    return _read(spark, d, "lineitem").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if(match).alias("n_match"))


def exam_subjects(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "exams")
    subject = F.lower(F.regexp_replace(strip(F.col("subject")), r"(?U)\s+", " "))
    return e.groupBy(subject.alias("subject")).agg(F.count("*").alias("n_exams"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_questions, clean_dedup, question_counts, options_clean, bbox_pixels, page_text_agg, ingest_stats, failed_pages, answer_keys, marks_parse, grade_status, grade_scores, grade_shown,
        msq_toggle, mcq_last_click, deadline_filter, json_decode, page_fail_fold, markdown_questions, html_questions, exam_markdown, empty_exams, comprehension_children, group_blocks,
        block_classes, question_runs, validation_issues, section_rollup, provenance, page_continuations, review_flags, short_answers, exam_subjects,
    )
}

_WS = r"[\s\p{Z}\x0b\x85\x1c-\x1f]"


def _stripped(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _number(x: str) -> str:
    return rf"TRY_CAST(nullif(regexp_extract({x}, '^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)', 1), '') AS DOUBLE)"


_HEADER = rf"regexp_replace(question_text, '(?i)^(?:Question Number{_WS}*:{_WS}*\d+{_WS}*)?(?:Question Id{_WS}*:{_WS}*\d+{_WS}*)?(?:Question Type{_WS}*:{_WS}*[A-Za-z]+{_WS}*)?', '')"
_CLEAN = _stripped(rf"regexp_replace({_stripped(_HEADER)}, '^\d+\.{_WS}*(?:…{_WS}*)?', '')")
_BASE = f"base AS (SELECT *, {_CLEAN} AS clean_text FROM questions WHERE question_text <> '')"
_FIRST = "(PARTITION BY exam_code, clean_text ORDER BY page_number, q_index, question_uid)"
_OPTION = _stripped(rf"regexp_replace(coalesce(o, 'None'), '^\d+\.{_WS}*(?:→{_WS}*|…{_WS}*)?', '')")
_OPTIONS = f"CASE WHEN upper(coalesce(question_type, 'MCQ')) IN ('COMPREHENSION', 'NAT', 'SA') OR options IS NULL OR len(options) > 8 THEN [] ELSE list_transform(options, lambda o: {_OPTION}) END"
_LATEST = "latest AS (SELECT * FROM page_documents QUALIFY row_number() OVER (PARTITION BY exam_code, page_number ORDER BY scanned_at DESC, page_uid DESC) = 1)"
_ITEMS = r"CASE WHEN regexp_matches(correct_answer, '(?s)^\s*\[.*\]\s*$') AND json_valid(correct_answer) THEN CAST(CAST(correct_answer AS JSON) AS VARCHAR[]) END"
_KEY = f"""k AS (SELECT *, {_ITEMS} AS items FROM questions),
keyed AS (SELECT question_uid, exam_code, metadata, CASE WHEN items IS NOT NULL THEN array_to_string(list_sort(list_transform(items, lambda x: upper(left({_stripped("x")}, 1)))), ',')
  ELSE coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(correct_answer, '[A-H]'))), ','), '') END AS answer_key FROM k)"""
_MARKS = f"marks AS (SELECT *, coalesce(nullif({_number("metadata['Correct Marks']")}, 0), 1) AS c_marks, coalesce(nullif({_number("metadata['Negative Marks']")}, 0), 0) AS n_marks FROM keyed)"
_RESP = "r AS (SELECT event_id, user_id, event_id AS question_uid, CASE WHEN k % 5 < 4 THEN chr(k % 5 + 65) ELSE '' END AS selected FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"
_GRADED = """graded AS (SELECT event_id, user_id, r.question_uid, CASE WHEN selected = '' THEN 'unanswered' WHEN selected = answer_key THEN 'correct' ELSE 'wrong' END AS status,
  CASE WHEN selected = '' THEN 0 WHEN selected = answer_key THEN coalesce(c_marks, 1) ELSE -coalesce(n_marks, 0) END AS score FROM r LEFT JOIN marks USING (question_uid))"""
_CLICKS = "c AS (SELECT user_id, event_id % 20 AS q_no, chr(CAST(json_extract_string(props, '$.k') AS INT) % 4 + 65) AS label, ts, event_id FROM events)"
_QUOTE = "chr(39)"
_SHOWN = f"""CASE WHEN items IS NOT NULL THEN CASE WHEN len(items) > 0 THEN '[' || array_to_string(list_transform(items, lambda x:
  CASE WHEN contains(x, {_QUOTE}) AND NOT contains(x, '"') THEN '"' || x || '"' ELSE {_QUOTE} || replace(x, {_QUOTE}, chr(92) || {_QUOTE}) || {_QUOTE} END), ', ') || ']' END ELSE nullif(correct_answer, '') END"""
_NUMBERED = f"""{_BASE}, kept AS (SELECT * FROM base WHERE page_number IS NOT NULL AND exam_code IS NOT NULL QUALIFY row_number() OVER {_FIRST} = 1),
typed AS (SELECT *, {_ITEMS} AS items, {_OPTIONS} AS opts, list_filter(images, lambda i: i IS NOT NULL) AS own FROM kept),
numbered AS (SELECT *, {_SHOWN} AS shown, list_filter(tables, lambda t: t IS NOT NULL) AS grids, map_entries(metadata) AS meta,
  list_transform(own, lambda i, k: {{'d': i.description, 'p': CASE WHEN len(i.bbox) = 4 THEN 'assets/figures/page_' || page_number || '_q_' || q_index || '_img_' || (k - 1) || '.png' END}}) AS figs,
  CAST(row_number() OVER (PARTITION BY exam_code ORDER BY page_number, q_index, question_uid) AS INT) AS ordinal FROM typed)"""
_NL = "chr(10)"
_ROW = "'| ' || array_to_string(list_transform({}, lambda c: coalesce(c, 'None')), ' | ') || ' |'"
_MD = f"""md AS (SELECT exam_code, ordinal, array_to_string(list_filter([
  '## Question ' || ordinal || ' (Type: ' || coalesce(question_type, 'MCQ') || ')' || {_NL},
  '**Correct Answer:** ' || shown || {_NL},
  CASE WHEN len(meta) > 0 THEN '**Metadata:**' || {_NL} || array_to_string(list_transform(meta, lambda e: '- **' || e.key || ':** ' || coalesce(e.value, 'None')), {_NL}) || {_NL} END,
  CASE WHEN clean_text <> '' THEN clean_text || {_NL} END,
  CASE WHEN len(list_filter(figs, lambda i: i.p IS NOT NULL)) > 0 THEN array_to_string(list_transform(list_filter(figs, lambda i: i.p IS NOT NULL), lambda i: '![' || coalesce(i.d, 'Image') || '](' || i.p || ')' || {_NL}), {_NL}) END,
  CASE WHEN len(tables) > 0 THEN array_to_string(list_transform(grids, lambda t: CASE WHEN len(t.headers) > 0 THEN {_ROW.format("t.headers")} || {_NL} || '|' || array_to_string(list_transform(t.headers, lambda h: '---'), '|') || '|' || {_NL}
    || coalesce(array_to_string(list_transform(coalesce(t.rows, []), lambda r: {_ROW.format("r")} || {_NL}), ''), '') ELSE '' END), {_NL}) END,
  CASE WHEN len(opts) > 0 THEN array_to_string(list_transform(opts, lambda o, j: '- **' || chr(CAST(64 + j AS INT)) || '.** ' || coalesce(o, 'None')), {_NL}) END,
  {_NL} || '---' || {_NL}], lambda x: x IS NOT NULL), {_NL}) AS md FROM numbered)"""


def _escaped(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("''", "&#39;")):
        x = f"replace({x}, '{a}', '{b}')"
    return f"coalesce({x}, '')"


def _many(items: str, of: str, each: str) -> str:
    return f"coalesce(array_to_string(list_transform({items}, lambda {of}: {each}), ''), '')"


_CELLS = lambda row, tag: _many(row, "c", f"'<{tag}>' || {_escaped("coalesce(c, 'None')")} || '</{tag}>'")
_HTML = f"""SELECT exam_code, ordinal, '<div class="question" id="q-' || ordinal || '" data-correct="' || {_escaped("CASE WHEN correct_answer IS NULL THEN 'null' WHEN items IS NOT NULL THEN correct_answer ELSE CAST(to_json(correct_answer) AS VARCHAR) END")}
  || '" data-cmarks="' || {_escaped("coalesce(metadata['Correct Marks'], '1')")} || '" data-nmarks="' || {_escaped("coalesce(metadata['Negative Marks'], '0')")} || '"><div class="question-header"><span>Q' || ordinal
  || '</span><span class="badge">' || {_escaped("coalesce(question_type, 'MCQ')")} || '</span><span class="badge marks-badge">+' || {_escaped("coalesce(metadata['Correct Marks'], '1')")} || ' / -' || {_escaped("coalesce(metadata['Negative Marks'], '0')")}
  || '</span></div><div class="question-text">' || {_escaped("clean_text")} || '</div>'
  || {_many("figs", "i", f"'<img src=" + '"' + "' || " + _escaped("i.p") + " || '" + '" alt="' + "' || " + _escaped("coalesce(i.d, 'Figure')") + " || '" + '">' + "'")}
  || {_many("grids", "t", f"'<table>' || CASE WHEN len(t.headers) > 0 THEN '<thead><tr>' || {_CELLS('t.headers', 'th')} || '</tr></thead>' ELSE '' END || '<tbody>' || {_many('t.rows', 'r', f"'<tr>' || {_CELLS('r', 'td')} || '</tr>'")} || '</tbody></table>'")}
  || CASE WHEN len(opts) > 0 THEN '<ul class="options-list">' || {_many("opts", "o, j", f"'<li class=" + '"option-item"><span class="option-label">' + "' || coalesce(['A','B','C','D','E','F','G','H'][j], '') || '</span><span>' || " + _escaped("coalesce(o, 'None')") + " || '</span></li>'")} || '</ul>' ELSE '' END
  || CASE WHEN shown IS NOT NULL THEN '<div class="hidden-answer"><strong>Correct Answer:</strong> ' || {_escaped("shown")} || '</div>' ELSE '' END
  || CASE WHEN len(meta) > 0 THEN '<ul class="metadata-content">' || {_many("meta", "m", f"'<li><span>' || {_escaped('m.key')} || ':</span> ' || {_escaped("coalesce(m.value, 'None')")} || '</li>'")} || '</ul>' ELSE '' END || '</div>' AS html FROM numbered"""
ORACLE = {
    "markdown_questions": f"WITH {_NUMBERED}, {_MD} SELECT exam_code, ordinal, md FROM md",
    "html_questions": f"WITH {_NUMBERED} {_HTML}",
    "exam_markdown": f"""WITH {_NUMBERED}, {_MD} SELECT exam_code, CAST(ordinal AS BIGINT) AS ord, CASE WHEN ordinal = 1 THEN '' ELSE {_NL} END || md AS part FROM md
UNION ALL SELECT exam_code, 0, '# Exam Questions (' || exam_code || ')' || {_NL} || {_NL} FROM exams
UNION ALL SELECT exam_code, 9223372036854775807, 'No questions found.' || {_NL} FROM exams WHERE exam_code NOT IN (SELECT exam_code FROM md)""",
    "page_fail_fold": f"""WITH RECURSIVE {_BASE}, r AS (SELECT *, CASE WHEN question_id IS NULL THEN 'before' WHEN question_type IS NULL THEN 'after' END AS failure,
  row_number() OVER (PARTITION BY exam_code ORDER BY page_number, q_index, question_uid) AS n FROM base WHERE exam_code IS NOT NULL AND page_number IS NOT NULL),
f AS (SELECT DISTINCT exam_code, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS seen, CAST(NULL AS INT) AS dead, CAST(NULL AS BIGINT) AS uid, CAST(NULL AS VARCHAR) AS txt FROM r
UNION ALL SELECT r.exam_code, r.n, CASE WHEN r.page_number IS NOT DISTINCT FROM f.dead OR failure IS NOT DISTINCT FROM 'before' OR list_contains(f.seen, r.clean_text) THEN f.seen ELSE list_append(f.seen, r.clean_text) END,
  CASE WHEN r.page_number IS NOT DISTINCT FROM f.dead THEN f.dead WHEN failure = 'before' OR (failure = 'after' AND NOT list_contains(f.seen, r.clean_text)) THEN r.page_number ELSE f.dead END,
  CASE WHEN r.page_number IS DISTINCT FROM f.dead AND failure IS NULL AND NOT list_contains(f.seen, r.clean_text) THEN r.question_uid END, r.clean_text FROM f JOIN r ON r.exam_code = f.exam_code AND r.n = f.n + 1)
SELECT uid AS question_uid, txt AS clean_text FROM f WHERE uid IS NOT NULL""",
    "grade_shown": f"WITH {_KEY}, {_MARKS}, {_RESP}, {_GRADED} SELECT user_id, printf('%.2f', CAST(sum(score) AS DOUBLE)) AS shown FROM graded GROUP BY 1",
    "clean_questions": f"WITH {_BASE} SELECT question_uid, exam_code, page_number, q_index, clean_text FROM base",
    "clean_dedup": f"WITH {_BASE} SELECT question_uid, exam_code, page_number, q_index, clean_text FROM base QUALIFY row_number() OVER {_FIRST} = 1",
    "question_counts": f"WITH {_BASE}, kept AS (SELECT * FROM base QUALIFY row_number() OVER {_FIRST} = 1) SELECT exam_code, upper(coalesce(question_type, 'MCQ')) AS type, count(*) AS n_questions FROM kept GROUP BY 1, 2",
    "options_clean": f"WITH o AS (SELECT question_uid, {_OPTIONS} AS opts FROM questions) SELECT question_uid, CAST(generate_subscripts(opts, 1) - 1 AS INT) AS pos, unnest(opts) AS option FROM o",
    "bbox_pixels": f"""WITH {_LATEST}, i AS (SELECT question_uid, exam_code, page_number, q_index, unnest(images) AS x, CAST(generate_subscripts(images, 1) - 1 AS INT) AS img FROM questions),
j AS (SELECT i.*, x.bbox AS b, width_px AS w, height_px AS h, CASE WHEN len(list_filter(x.bbox, lambda v: v >= 0 AND v <= 1)) = 4 THEN 1.0 ELSE 1000.0 END::DOUBLE AS s FROM i JOIN latest USING (exam_code, page_number) WHERE len(x.bbox) = 4 AND len(list_filter(x.bbox, lambda v: v IS NULL)) = 0)
SELECT question_uid, img, CAST(trunc(b[2] / s * w) AS INT) AS "left", CAST(trunc(b[1] / s * h) AS INT) AS top, CAST(trunc(b[4] / s * w) AS INT) AS "right", CAST(trunc(b[3] / s * h) AS INT) AS bottom,
'assets/figures/page_' || page_number || '_q_' || q_index || '_img_' || img || '.png' AS local_path FROM j""",
    "page_text_agg": """WITH p AS (SELECT DISTINCT exam_code, page_number FROM page_documents),
t AS (SELECT exam_code, page_number, coalesce(string_agg(raw_text, chr(10) ORDER BY block_index) FILTER (raw_text <> ''), '') AS t, CAST(count(*) AS INT) AS n FROM classified_blocks GROUP BY 1, 2)
SELECT exam_code, page_number, coalesce(t, '') AS page_text, coalesce(n, 0) AS n_blocks FROM p LEFT JOIN t USING (exam_code, page_number)""",
    "ingest_stats": "SELECT exam_code, count(*) FILTER (NOT coalesce(parse_failed, false)) AS n_ok, count(*) AS n_total, count(*) FILTER (parse_failed) AS n_failed, bool_and(coalesce(parse_failed, false)) AS all_failed FROM page_documents GROUP BY 1",
    "failed_pages": f"""WITH {_LATEST} SELECT exam_code, page_number, page_uid, CAST(CASE WHEN parse_failed THEN 0 ELSE coalesce(length(raw_text), 0) END AS INT) AS n_chars,
CAST(CASE WHEN parse_failed THEN 0 ELSE coalesce(len(docling_blocks), 0) END AS INT) AS n_blocks, coalesce(parse_failed, false) AS parse_failed FROM latest""",
    "answer_keys": f"WITH {_KEY} SELECT question_uid, answer_key FROM keyed",
    "marks_parse": f"WITH {_KEY}, {_MARKS} SELECT question_uid, CAST(c_marks AS DOUBLE) AS c_marks, CAST(n_marks AS DOUBLE) AS n_marks FROM marks",
    "grade_status": f"WITH {_KEY}, {_MARKS}, {_RESP}, {_GRADED} SELECT event_id, question_uid, status, CAST(score AS DOUBLE) AS score FROM graded",
    "grade_scores": f"WITH {_KEY}, {_MARKS}, {_RESP}, {_GRADED} SELECT user_id, round(CAST(sum(score) AS DOUBLE), 6) AS score, count(*) FILTER (status = 'correct') AS n_correct, count(*) FILTER (status = 'wrong') AS n_wrong, count(*) FILTER (status = 'unanswered') AS n_unanswered FROM graded GROUP BY 1",
    "msq_toggle": f"WITH {_CLICKS}, l AS (SELECT user_id, q_no, label, count(*) % 2 = 1 AS lit FROM c GROUP BY 1, 2, 3) SELECT user_id, q_no, coalesce(string_agg(label, ',' ORDER BY label) FILTER (lit), '') AS selected FROM l GROUP BY 1, 2",
    "mcq_last_click": f"WITH {_CLICKS} SELECT user_id, q_no, arg_max(label, (ts, event_id)) AS selected FROM c GROUP BY 1, 2",
    "deadline_filter": "SELECT event_id, user_id FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS s FROM events) WHERE ts <= s + INTERVAL 90 MINUTE",
    "json_decode": "SELECT event_id, CASE WHEN event_id % 5 IN (0, 3) THEN CAST(json_extract_string(props, '$.k') AS INT) END AS k, event_id % 5 NOT IN (0, 3) AS quarantined FROM events",
    "empty_exams": "SELECT exam_code FROM exams WHERE exam_code NOT IN (SELECT exam_code FROM questions WHERE question_text <> '' AND exam_code IS NOT NULL)",
    "comprehension_children": "WITH p AS (SELECT exam_code, question_id, min(group_id) AS parent_group FROM question_groups WHERE question_id IS NOT NULL GROUP BY 1, 2) SELECT c.group_id, p.parent_group FROM question_groups c LEFT JOIN p ON c.exam_code = p.exam_code AND c.parent_comprehension_id = p.question_id WHERE c.parent_comprehension_id IS NOT NULL",
    "group_blocks": "WITH g AS (SELECT group_id, exam_code, unnest(block_indices) AS block_index, CAST(generate_subscripts(block_indices, 1) - 1 AS INT) AS pos FROM question_groups) SELECT group_id, pos, block_id, block_type FROM g LEFT JOIN classified_blocks USING (exam_code, block_index)",
    "block_classes": r"""SELECT block_id, CASE WHEN NOT regexp_matches(coalesce(raw_text, ''), '\S') THEN 'unknown' WHEN regexp_matches(raw_text, '(?i)^\s*question (number|id)\s*:') THEN 'question_header' WHEN regexp_matches(raw_text, '\$[^$]+\$') THEN 'math_inline'
WHEN regexp_matches(raw_text, '(?m)^\s*\|.*\|\s*$') THEN 'table' WHEN regexp_matches(raw_text, '(?m)^\s*(\d+|[A-H])[.)]\s+\S') THEN 'option_block' WHEN regexp_matches(raw_text, '\?\s*$') THEN 'question_text' ELSE 'text' END AS tag FROM classified_blocks""",
    "question_runs": "SELECT block_id, CAST(sum(CASE WHEN block_type = 'question_text' THEN 1 ELSE 0 END) OVER (PARTITION BY exam_code, page_number ORDER BY block_index ROWS UNBOUNDED PRECEDING) AS INT) AS run FROM classified_blocks",
    "validation_issues": r"""SELECT question_uid, concat_ws(',', CASE WHEN len(regexp_extract_all(t, '\{')) <> len(regexp_extract_all(t, '\}')) THEN 'braces' END, CASE WHEN len(regexp_extract_all(t, '\$')) % 2 = 1 THEN 'dollars' END,
CASE WHEN NOT regexp_matches(t, '\S') THEN 'no_text' END, CASE WHEN len(options) > 8 THEN 'options' END,
CASE WHEN len(list_filter(tables, lambda x: len(list_filter(x.rows, lambda r: len(r) <> len(x.headers))) > 0)) > 0 THEN 'ragged_table' END) AS issues FROM (SELECT *, coalesce(question_text, '') AS t FROM questions)""",
    "section_rollup": "SELECT exam_code, section_id, count(*) AS n_questions, count(*) FILTER (is_comprehension) AS n_comprehension, min(start_page) AS first_page, max(end_page) AS last_page FROM question_groups GROUP BY 1, 2",
    "provenance": r"SELECT exam_code, count(*) AS n_questions, count(*) FILTER (question_id IS NULL) AS n_without_id, count(*) FILTER (NOT regexp_matches(coalesce(question_text, ''), '\S')) AS n_without_text, count(*) FILTER (correct_answer IS NULL) AS n_without_answer, count(*) FILTER (len(images) > 0) AS n_with_images, count(*) FILTER (len(tables) > 0) AS n_with_tables FROM questions GROUP BY 1",
    "page_continuations": rf"""WITH {_LATEST}, l AS (SELECT exam_code, page_number, nullif(regexp_extract(raw_text, '^\s*(\S[^\n]*)', 1), '') AS head, nullif(regexp_extract(raw_text, '([^\n]*\S)\s*$', 1), '') AS tail FROM latest)
SELECT a.exam_code, a.page_number, b.page_number AS next_page, rtrim(a.tail) || ' ' || ltrim(b.head) AS stitched FROM l a JOIN l b ON a.exam_code = b.exam_code AND b.page_number = a.page_number + 1 WHERE right(a.tail, 1) NOT IN ('.', '?', '!', ':', ';') AND b.head IS NOT NULL""",
    "review_flags": "WITH l AS (SELECT doc_id, min(quality) AS q FROM labels GROUP BY 1) SELECT source, count(*) AS n_docs, count(*) FILTER (q <= 2) AS n_review, count(*) FILTER (q IS NULL) AS n_unlabelled FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1",
    "short_answers": "SELECT kind, count(*) AS n, count(*) FILTER (CASE kind WHEN 'Range' THEN q BETWEEN 10 AND 20 WHEN 'Set' THEN q IN (5, 7, 11) ELSE q = 5 END) AS n_match FROM (SELECT CASE l_linenumber % 3 WHEN 0 THEN 'Range' WHEN 1 THEN 'Set' ELSE 'Equal' END AS kind, CAST(trunc(l_quantity) AS INT) AS q FROM lineitem) GROUP BY 1",
    "exam_subjects": rf"SELECT lower(regexp_replace({_stripped("subject")}, '{_WS}+', ' ', 'g')) AS subject, count(*) AS n_exams FROM exams GROUP BY 1",
}
