"""Rendering of questions as Markdown and HTML.

Each question is rendered by itself, so an exam of any size stays spread over
the cluster; the parts of an exam are ordered by (page, index) ordinals and
joined when they are written, as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KATEX = "https://cdn.jsdelivr.net/npm/katex@0.16.9/dist"


def with_ordinals(questions: DataFrame, exam: str = "exam_code", page: str = "page_number", index: str = "q_index") -> DataFrame:
    """Adds ``ordinal``, 1-based in the exam. Counts of pages are summed up
    before windows run, so that no window holds an exam's questions."""
    per_page = questions.groupBy(exam, page).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(exam).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_page.select(exam, page, before.alias("_before"))
    own = F.row_number().over(Window.partitionBy(exam, page).orderBy(index))
    return questions.join(offsets, [exam, page]).withColumn("ordinal", (F.col("_before") + own).cast("int")).drop("_before")


def _python_list(items: Column) -> Column:
    """Text of a list as Python prints it (texts without both kinds of quotes)."""
    quoted = F.transform(items, lambda x: F.when(x.contains("'") & ~x.contains('"'), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'"))))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def shown_answer(answer: Column) -> Column:
    """The answer as it is shown: a JSON array as a list; null for none."""
    items = F.from_json(F.when(answer.rlike(r"(?s)^\s*\[.*\]\s*$") & F.try_parse_json(answer).isNotNull(), answer), "array<string>")
    return F.when(items.isNotNull(), F.when(F.size(items) > 0, _python_list(items))).otherwise(F.nullif(answer, F.lit("")))


def _lines(*lines: Column) -> Column:
    """Lines joined; null lines are left out."""
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def markdown_question(ordinal: Column, kind: Column, answer: Column, metadata: Column, text: Column, images: Column, tables: Column, options: Column) -> Column:
    """One question: heading, answer, metadata, text, figures with a local
    path, tables with headers, options, rule. Null parts are left out; a null
    option or cell prints as None."""
    n = lambda c: F.coalesce(c, F.lit("None"))
    shown = shown_answer(answer)
    meta = F.when(F.size(metadata) > 0, F.concat(F.lit("**Metadata:**\n"), F.array_join(F.transform(F.map_entries(metadata), lambda e: F.concat(F.lit("- **"), e["key"], F.lit(":** "), n(e["value"]))), "\n"), F.lit("\n")))
    figures = F.filter(images, lambda i: F.coalesce(i["local_path"], F.lit("")) != "")
    figure = F.when(F.size(figures) > 0, F.array_join(F.transform(figures, lambda i: F.concat(F.lit("!["), F.coalesce(i["description"], F.lit("Image")), F.lit("]("), i["local_path"], F.lit(")\n"))), "\n"))
    row = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, n), " | "), F.lit(" |"))

    def table(t: Column) -> Column:
        head = F.concat(row(t["headers"]), F.lit("\n|"), F.array_join(F.transform(t["headers"], lambda _: F.lit("---")), "|"), F.lit("|\n"))
        rows = F.array_join(F.transform(F.coalesce(t["rows"], F.array().cast("array<array<string>>")), lambda r: F.concat(row(r), F.lit("\n"))), "")
        return F.when(F.size(t["headers"]) > 0, F.concat(head, rows)).otherwise(F.lit(""))

    grid = F.when(F.size(tables) > 0, F.array_join(F.transform(F.array_compact(tables), table), "\n"))
    choice = F.when(F.size(options) > 0, F.array_join(F.transform(options, lambda o, j: F.concat(F.lit("- **"), F.char(F.lit(65) + j), F.lit(".** "), n(o))), "\n"))
    return _lines(
        F.format_string("## Question %d (Type: %s)\n", ordinal, F.coalesce(kind, F.lit("MCQ"))),
        F.when(shown.isNotNull(), F.concat(F.lit("**Correct Answer:** "), shown, F.lit("\n"))),
        meta, F.when(text != "", F.concat(text, F.lit("\n"))), figure, grid, choice, F.lit("\n---\n"),
    )


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_card(ordinal: Column, kind: Column, answer: Column, metadata: Column, text: Column, images: Column, tables: Column, options: Column, parity_html: bool = False) -> Column:
    """One question card. Texts are escaped unless ``parity_html``; the key in
    data-correct always is. Labels beyond H are empty."""
    e = (lambda c: c) if parity_html else escape
    cat = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else F.coalesce(x, F.lit("")) for x in p])
    many = lambda items, f: F.coalesce(F.array_join(F.transform(items, f), ""), F.lit(""))
    c_marks, n_marks = F.coalesce(F.try_element_at(metadata, F.lit("Correct Marks")), F.lit("1")), F.coalesce(F.try_element_at(metadata, F.lit("Negative Marks")), F.lit("0"))
    is_list = answer.rlike(r"(?s)^\s*\[.*\]\s*$") & F.try_parse_json(answer).isNotNull()
    data = F.when(answer.isNull(), F.lit("null")).when(is_list, answer).otherwise(F.regexp_extract(F.to_json(F.struct(answer.alias("a"))), r"(?s)^\{\"a\":(.*)\}$", 1))
    label = lambda j: F.coalesce(F.get(F.array(*[F.lit(x) for x in "ABCDEFGH"]), j), F.lit(""))
    cells = lambda row, tag: many(row, lambda c: cat(f"<{tag}>", e(F.coalesce(c, F.lit("None"))), f"</{tag}>"))
    table = lambda t: cat("<table>", F.when(F.size(t["headers"]) > 0, cat("<thead><tr>", cells(t["headers"], "th"), "</tr></thead>")), "<tbody>", many(t["rows"], lambda r: cat("<tr>", cells(r, "td"), "</tr>")), "</tbody></table>")
    shown = shown_answer(answer)
    return cat(
        '<div class="question" id="q-', ordinal.cast("string"), '" data-correct="', escape(data), '" data-cmarks="', e(c_marks), '" data-nmarks="', e(n_marks), '">',
        '<div class="question-header"><span>Q', ordinal.cast("string"), '</span><span class="badge">', e(F.coalesce(kind, F.lit("MCQ"))), '</span><span class="badge marks-badge">+', e(c_marks), " / -", e(n_marks), "</span></div>",
        '<div class="question-text">', e(text), "</div>",
        many(images, lambda i: cat('<img src="', e(i["local_path"]), '" alt="', e(F.coalesce(i["description"], F.lit("Figure"))), '">')),
        many(F.array_compact(tables), table),
        F.when(F.size(options) > 0, cat('<ul class="options-list">', many(F.transform(options, lambda o, j: F.struct(o.alias("o"), label(j).alias("l"))), lambda x: cat('<li class="option-item"><span class="option-label">', x["l"], "</span><span>", e(F.coalesce(x["o"], F.lit("None"))), "</span></li>")), "</ul>")),
        F.when(shown.isNotNull(), cat('<div class="hidden-answer"><strong>Correct Answer:</strong> ', e(shown), "</div>")),
        F.when(F.size(metadata) > 0, cat('<ul class="metadata-content">', many(F.map_entries(metadata), lambda m: cat("<li><span>", e(m["key"]), ":</span> ", e(F.coalesce(m["value"], F.lit("None"))), "</li>")), "</ul>")),
        "</div>",
    )


#: The page's own style and script: choices, a countdown, an answer panel in
#: practice mode, and scores by the same rules as ``grade``.
STYLE = """body{font-family:sans-serif;max-width:60rem;margin:auto;padding:1rem}.question{border:2px solid #ddd;border-radius:8px;padding:1rem;margin:1rem 0}
.question.correct{border-color:#16a34a}.question.wrong{border-color:#dc2626}.question.unanswered{border-color:#94a3b8}.badge{margin-left:.5rem;padding:0 .5rem;background:#eef}
.question img{max-width:100%}.options-list{list-style:none;padding:0}.option-item{cursor:pointer;padding:.3rem}.option-item.selected{background:#dbeafe}.option-label{font-weight:bold;margin-right:.5rem}
table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.2rem .5rem}.hidden-answer{display:none}body.practice .hidden-answer,body.done .hidden-answer{display:block}"""
SCRIPT = r"""const cards=()=>[...document.querySelectorAll('.question')];let left=90*60,clock=null;
function labels(card){return (card.dataset.selected||'').split(',').filter(x=>x)}
function choose(card,item){const l=item.querySelector('.option-label').textContent;let now=labels(card);
 if(card.querySelector('.badge').textContent==='MSQ')now=now.includes(l)?now.filter(x=>x!==l):[...now,l].sort();else now=[l];
 card.dataset.selected=now.join(',');card.querySelectorAll('.option-item').forEach(i=>i.classList.toggle('selected',now.includes(i.querySelector('.option-label').textContent)))}
function key(card){let v;try{v=JSON.parse(card.dataset.correct)}catch(e){return ''}
 if(Array.isArray(v))return v.map(s=>String(s).trim().charAt(0).toUpperCase()).sort().join(',');
 return typeof v==='string'?[...new Set(v.match(/[A-H]/g)||[])].sort().join(','):''}
function submitExam(){clearInterval(clock);let total=0;for(const c of cards()){const s=c.dataset.selected||'',k=key(c),plus=parseFloat(c.dataset.cmarks)||1,minus=parseFloat(c.dataset.nmarks)||0;
 const state=!s?'unanswered':s===k&&k?'correct':'wrong';total+=state==='correct'?plus:state==='wrong'?-minus:0;c.classList.remove('correct','wrong','unanswered');c.classList.add(state)}
 document.body.classList.add('done');document.getElementById('score').textContent='Score: '+total.toFixed(2)}
function mode(exam){document.body.classList.toggle('practice',!exam);clearInterval(clock);left=90*60;
 if(exam){document.body.classList.remove('done');cards().forEach(c=>{delete c.dataset.selected;c.classList.remove('correct','wrong','unanswered');c.querySelectorAll('.selected').forEach(i=>i.classList.remove('selected'))});
 clock=setInterval(()=>{left--;document.getElementById('clock').textContent=Math.floor(left/60)+':'+String(left%60).padStart(2,'0');if(left<=0)submitExam()},1000)}}
document.addEventListener('click',e=>{const i=e.target.closest('.option-item');if(i)choose(i.closest('.question'),i)});
document.addEventListener('DOMContentLoaded',()=>{mode(false);if(window.renderMathInElement)renderMathInElement(document.body,{delimiters:[{left:'$$',right:'$$',display:true},{left:'$',right:'$',display:false}]})});"""
HTML_TAIL = "</body></html>"


def html_head(exam: Column, katex: str = KATEX, parity_html: bool = False) -> Column:
    name = exam if parity_html else escape(exam)
    math = f'<link rel="stylesheet" href="{katex}/katex.min.css"><script defer src="{katex}/katex.min.js"></script><script defer src="{katex}/contrib/auto-render.min.js"></script>'
    bar = '<div><button onclick="mode(true)">Exam</button><button onclick="mode(false)">Practice</button><button onclick="submitExam()">Submit</button> <span id="clock"></span> <strong id="score"></strong></div>'
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en"><head><meta charset="UTF-8"><title>'), name, F.lit(f" Questions</title>{math}<style>{STYLE}</style></head><body><div class=\"header-title\">"), name,
        F.lit(f"</div>{bar}<script>{SCRIPT}</script>\n"),
    )


def in_parts(exams: DataFrame, parts: DataFrame, head: Column, none: Column, tail: Column, between: str = "\n", exam: str = "exam_code") -> DataFrame:
    """(exam, ord, part): the document of each exam in parts that joined in
    order are its text: a head at 0, the parts at their ordinals with
    ``between`` in front of all but the first, and the tail last. Exams without
    parts get ``none``. No document has to fit into a row."""
    each = parts.select(exam, F.col("ordinal").cast("bigint").alias("ord"), F.concat(F.when(F.col("ordinal") == 1, "").otherwise(between), "part").alias("part"))
    some = parts.select(exam).distinct().withColumn("_some", F.lit(True))
    ends = exams.select(exam).join(some, exam, "left").select(exam, head.alias("_h"), F.when(F.col("_some"), tail).otherwise(F.concat(none, tail)).alias("_t"))
    at = F.array(F.struct(F.lit(0).cast("bigint").alias("ord"), F.col("_h").alias("part")), F.struct(F.lit((1 << 63) - 1).alias("ord"), F.col("_t").alias("part")))
    return each.unionByName(ends.select(exam, F.inline(at)))
