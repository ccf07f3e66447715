"""Extractor responses: fences, strict JSON, quarantine."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import strip
from ..storage import stage

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


QUESTION = _struct(
    question_id=_S, question_type=_S, question_text=_S, options=T.ArrayType(_S), correct_answer=_S, metadata=T.MapType(_S, _S),
    tables=T.ArrayType(_struct(headers=T.ArrayType(_S), rows=T.ArrayType(T.ArrayType(_S)))), images=T.ArrayType(_struct(type=_S, description=_S, bbox=T.ArrayType(T.DoubleType()))),
)


def strip_fence(text: Column) -> Column:
    opened = F.regexp_replace(text, r"(?U)```json\s*", "")
    return strip(F.regexp_replace(opened, r"(?U)```\s*$", ""))


@F.pandas_udf(_struct(body=_S, error=_S))
def strict_json(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The text as strict JSON, written anew (the last of repeated keys wins);
    otherwise the error. SQL parsers accept more or less than this."""
    for s in texts:
        body, error = [], []
        for t in s:
            try:
                body.append(json.dumps(json.loads(t), ensure_ascii=False))
                error.append(None)
            except (TypeError, ValueError, RecursionError) as e:
                body.append(None)
                error.append(str(e)[:200] or "error")
        yield pd.DataFrame({"body": body, "error": error})


def decode_marked(responses: DataFrame, text: str) -> DataFrame:
    """Adds ``body`` and ``error``, one of them null. One pass: the parser is
    marked nondeterministic, so no filter makes it run again."""
    parsed = responses.withColumn("_json", strict_json.asNondeterministic()(strip_fence(F.col(text))))
    return parsed.withColumns({"body": F.col("_json.body"), "error": F.col("_json.error")}).drop("_json")


def decode(responses: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(decoded with ``body``, quarantine with ``error``), parsed once."""
    marked = stage(decode_marked(responses, text), "decoded")
    return marked.filter("body IS NOT NULL").drop("error"), marked.filter("body IS NULL").drop("body")


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False) if isinstance(x, (dict, list)) else str(x)


def _failure(q: object) -> str | None:
    """Where processing of one question fails: 'before' or 'after' its text
    counts as seen, or None."""
    if not isinstance(q, dict):
        return "before"
    text = q.get("question_text", "")
    if not text:
        return None
    if not isinstance(text, str):
        return "before"
    kind = q.get("question_type", "MCQ")
    if not isinstance(kind, str):
        return "after"
    options = q.get("options")
    if kind.upper() not in ("COMPREHENSION", "NAT", "SA") and options and not hasattr(options, "__len__"):
        return "after"
    images = q.get("images", [])
    if not isinstance(images, (list, dict, str)):
        return "after"
    for image in images:
        if not isinstance(image, dict):
            return "after"
        box = image.get("bbox")
        if box and not hasattr(box, "__len__"):
            return "after"
        if box and len(box) == 4 and not all(isinstance(v, (int, float)) and v == v and abs(v) != float("inf") for v in box):
            return "after"
    return None


def _typed(d: dict) -> dict:
    """The known fields of a question, each null where its kind is wrong."""
    options, tables, images, meta = d.get("options"), d.get("tables"), d.get("images"), d.get("metadata")

    def table(t: dict) -> dict:
        rows = t.get("rows") or []
        return {"headers": [_text(h) for h in t.get("headers") or []], "rows": [[str(c) for c in r] if isinstance(r, (list, str)) else [str(r)] for r in rows]}

    def image(m: dict) -> dict:
        box = m.get("bbox")
        numbers = isinstance(box, list) and all(isinstance(v, (int, float)) for v in box)
        return {"type": _text(m.get("type")), "description": _text(m.get("description")), "bbox": [float(v) for v in box] if numbers else None}

    return {
        **{k: _text(d.get(k)) for k in ("question_id", "question_type", "correct_answer")},
        "question_text": _text(d.get("question_text") or None),
        "options": [str(o) for o in options] if isinstance(options, (list, str, dict)) else None,
        "metadata": [(str(k), _text(v)) for k, v in meta.items()] if isinstance(meta, dict) else None,
        "tables": [table(t) for t in tables if isinstance(t, dict)] if isinstance(tables, list) else None,
        "images": [image(m) for m in images if isinstance(m, dict)] if isinstance(images, list) else None,
    }


def explode_questions(decoded: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """The questions of decoded responses: the kept columns, q_index (the place
    in the response), failure, raw (the whole object as JSON, so that unknown
    keys stay) and the fields of QUESTION. A response or list of the wrong
    kind has no questions."""
    source = decoded.select(*keep, F.col(body).alias("_body"))
    fields = [T.StructField("q_index", T.IntegerType()), T.StructField("failure", _S), T.StructField("raw", _S), *QUESTION.fields]
    out = T.StructType([*source.schema.fields[:-1], *fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parent = [], []
            for k, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
                page = json.loads(text)
                items = page.get("questions", []) if isinstance(page, dict) else []
                for i, q in enumerate(items if isinstance(items, list) else []):
                    parent.append(k)
                    rows.append({"q_index": i, "failure": _failure(q), "raw": json.dumps(q, ensure_ascii=False), **_typed(q if isinstance(q, dict) else {})})
            kept = [c.take(pa.array(parent, pa.int32())) for c in b.columns[:-1]]
            new = [pa.array([r[f.name] for r in rows], f.type) for f in list(arrow)[len(kept) :]]
            yield pa.RecordBatch.from_arrays([*kept, *new], schema=arrow)

    return source.mapInArrow(run, out)
