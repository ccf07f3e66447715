"""Sources and sinks: PDF files, JSON documents, text and image files."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from itertools import chain, count

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.extract import time_limit

PAGES = "path string, exam_code string, page_number int, raster binary, width_px int, height_px int, parse_failed boolean"


def stem(path: str = "path"):
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]+$", "")


def scan_directory(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder (not of its subfolders): path, exam_code, content.
    Raises FileNotFoundError if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return files.withColumn("exam_code", stem())


def scan_file(spark: SparkSession, path: str, exam_code: str | None = None) -> DataFrame:
    """One file; ``exam_code`` overrides the file's stem."""
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(path)
    files = spark.read.format("binaryFile").load(path)
    return files.withColumn("exam_code", F.lit(exam_code) if exam_code else stem())


def rasterise(files: DataFrame, renderers: list[Callable[[bytes, int], Iterator[tuple[bytes, int, int]]]], dpi: int = 300, timeout: float | None = 30) -> DataFrame:
    """One row per page, one page per batch, so that memory holds a file and
    one raster. ``renderers`` are tried in order: each turns a file's bytes
    into (rgb bytes, width, height), page by page. Where one fails, or takes
    longer than ``timeout`` seconds for a page, the next goes on from that
    page; where none can, the page is a failed row and the file ends there (a
    file of which no page can be read has one failed row without a page). No
    failure leaves its file."""
    kinds = pa.schema([("path", pa.string()), ("exam_code", pa.string()), ("page_number", pa.int32()), ("raster", pa.binary()), ("width_px", pa.int32()), ("height_px", pa.int32()), ("parse_failed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(*values: object) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, kinds)], schema=kinds)

        for b in batches:
            for path, code, content in zip(*[b.column(i) for i in range(3)]):
                path, code, content = path.as_py(), code.as_py(), content.as_py()
                done, whole = 0, False
                for render in renderers:
                    try:
                        with time_limit(timeout):
                            pages = iter(render(content, dpi))
                        for n in count(1):
                            with time_limit(timeout):
                                page = next(pages, None)
                                made = row(path, code, n, *page, False) if page is not None and n > done else None
                            if page is None:
                                whole = True
                                break
                            if made is not None:
                                done = n
                                yield made
                    except Exception:
                        continue
                    if whole:
                        break
                if not whole:
                    yield row(path, code, done + 1 if done else None, None, None, None, True)

    return files.select("path", "exam_code", "content").mapInArrow(run, PAGES)


def _member(element: object, name: str) -> object:
    return element.get(name) if isinstance(element, dict) else getattr(element, name, None)


def normalise_element(element: object) -> tuple[int, str | None, str | None] | None:
    """(page, text, label) of a parser's element, given as an object or a
    dictionary, or in a tuple of which the first of two members that has a
    provenance counts; the page under page_no or else page. None without."""
    if isinstance(element, tuple):
        with_origin = [e for e in element[:2] if _member(e, "prov")]
        element = with_origin[0] if with_origin else element[0] if element else None
    origin = _member(element, "prov")
    if not origin:
        return None
    page = _member(origin[0], "page_no") or _member(origin[0], "page")
    text, label = _member(element, "text"), _member(element, "label")
    return (int(page), None if text is None else str(text), None if label is None else str(label)) if page else None


def text_layer(files: DataFrame, parser: Callable[[bytes], Iterator[object]]) -> DataFrame:
    """(exam_code, page_number, ord, label, text): the elements of each file
    in document order. A file that ``parser`` can't read has none."""
    kinds = pa.schema([("exam_code", pa.string()), ("page_number", pa.int32()), ("ord", pa.int32()), ("label", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for code, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    found = [(code, e[0], i, e[2], e[1]) for i, e in enumerate(map(normalise_element, parser(content.as_py()))) if e]
                except Exception:
                    found = []
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * 5, kinds)], schema=kinds)

    return files.select("exam_code", "content").mapInArrow(run, "exam_code string, page_number int, ord int, label string, text string")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(exam_code, body): JSON documents, one per file."""
    return spark.read.text(path, wholetext=True).select(stem("_metadata.file_path").alias("exam_code"), F.col("value").alias("body"))


def _target(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: a URI, or a local (mounted) path."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), os.path.abspath(folder))


def write_files(df: DataFrame, folder: str, name: str, content: str) -> None:
    """One file per row, written by the executors below a shared folder (a
    path, or a URI such as hdfs:// or s3://). A retried task writes the same
    files again; each appears whole (written aside and moved)."""

    def save(rows: Iterator) -> None:
        system, root = _target(folder)
        for r in rows:
            path = f"{root}/{r[0]}"
            system.create_dir(os.path.dirname(path), recursive=True)
            aside = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(aside) as f:
                f.write(r[1].encode() if isinstance(r[1], str) else bytes(r[1]))
            system.move(aside, path)

    df.select(name, content).filter(F.col(content).isNotNull()).foreachPartition(save)


def write_in_order(parts: DataFrame, folder: str) -> None:
    """parts: (name, ord, part). Each file's parts in order, written as a
    stream: a file of any size needs the memory of one part."""

    def save(rows: Iterator) -> None:
        system, root = _target(folder)
        path, out, aside = None, None, None
        for r in chain(rows, [None]):
            if r is None or f"{root}/{r[0]}" != path:
                if out is not None:
                    out.close()
                    system.move(aside, path)
                if r is None:
                    break
                path = f"{root}/{r[0]}"
                system.create_dir(os.path.dirname(path), recursive=True)
                aside = f"{path}.{uuid.uuid4().hex}.part"
                out = system.open_output_stream(aside)
            out.write(r[1].encode())

    ordered = parts.filter("name IS NOT NULL AND part IS NOT NULL").repartition("name").sortWithinPartitions("name", "ord")
    ordered.select("name", "part").foreachPartition(save)


@F.pandas_udf(T.StringType())
def question_json(raw: pd.Series, page: pd.Series, text: pd.Series, options: pd.Series, paths: pd.Series) -> pd.Series:
    """A question's own object (unknown keys kept, in their order) with its
    page, cleaned text, cleaned options and the places of its figures."""

    def one(r: str, p: int, t: str, o: list | None, where: list | None) -> str:
        q = json.loads(r)
        q |= {"page_number": int(p), "question_text": t, "options": list(o) if o is not None else []}
        for image, path in zip(q.get("images") or [], where if where is not None else []):
            if path and isinstance(image, dict):
                image["local_path"] = path
        return json.dumps(q)

    return pd.Series([one(*x) for x in zip(raw, page, text, options, paths)])


@F.pandas_udf(T.StringType())
def pretty(bodies: pd.Series) -> pd.Series:
    """JSON with an indent of two as a member of a list in an object, ASCII
    only."""
    return bodies.map(lambda b: "    " + json.dumps(json.loads(b), indent=2).replace("\n", "\n    "))


def document_parts(exams: DataFrame, numbered: DataFrame) -> DataFrame:
    """(exam_code, ord, part): the result document of each exam, in parts that
    joined in order are its JSON text. numbered: questions with ``ordinal``."""
    body = pretty(question_json("raw", "page_number", "question_text", "options", F.col("images.local_path")))
    each = numbered.select("exam_code", F.col("ordinal").cast("bigint").alias("ord"), F.concat(F.when(F.col("ordinal") == 1, "\n").otherwise(",\n"), body).alias("part"))
    some = numbered.select("exam_code").distinct().withColumn("some", F.lit(True))
    ends = exams.select("exam_code").join(some, "exam_code", "left")
    head = ends.select("exam_code", F.lit(0).cast("bigint").alias("ord"), F.lit('{\n  "questions": [').alias("part"))
    tail = ends.select("exam_code", F.lit((1 << 63) - 1).alias("ord"), F.when(F.col("some"), "\n  ]\n}").otherwise("]\n}").alias("part"))
    return head.unionByName(each).unionByName(tail)
