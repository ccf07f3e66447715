"""The extractor: a pluggable function from page image and prompt to text."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROMPT = "Extract every question of this page as JSON: an object with a list under the key questions."


class Overtime(Exception):
    """A call took longer than its limit."""


@contextmanager
def time_limit(seconds: float | None) -> Iterator[None]:
    """Raises Overtime in the body after ``seconds``. An alarm of the process,
    so it works in the main thread only (where Spark's workers run Python) and
    on systems that have alarms; elsewhere, and for None or 0, no limit."""
    usable = bool(seconds) and hasattr(signal, "setitimer") and threading.current_thread() is threading.main_thread()
    if not usable:
        yield
        return

    def stop(*_: object) -> None:
        raise Overtime(f"more than {seconds} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def first_that_loads(*attempts: Callable[[], Callable[[object, str], str]]) -> Callable[[], Callable[[object, str], str]]:
    """A loader that tries others in order, for instance with and without
    trust in a model's own code; the last failure is raised."""

    def load() -> Callable[[object, str], str]:
        failure: Exception = RuntimeError("no loader")
        for attempt in attempts:
            try:
                return attempt()
            except Exception as e:
                failure = e
        raise failure

    return load


def with_responses(pages: DataFrame, image: str, load: Callable[[], Callable[[object, str], str]], prompt: str = PROMPT, timeout: float | None = None) -> DataFrame:
    """Adds ``response`` and ``error``. ``load`` runs once in each worker and
    gives the extractor; if that fails, all pages of the worker fail. A page
    that fails or takes longer than ``timeout`` seconds gets a null response.
    The column is marked nondeterministic, so it is computed once for each
    page; write the result before reading it twice."""

    @F.pandas_udf("struct<response string, error string>")
    def call(images: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            extractor, broken = load(), None
        except Exception as e:
            extractor, broken = None, f"no extractor: {e}"[:500]
        for s in images:
            out = []
            for x in s:
                if broken:
                    out.append((None, broken))
                    continue
                try:
                    with time_limit(timeout):
                        out.append((extractor(x, prompt), None))
                except Exception as e:
                    out.append((None, str(e)[:500] or type(e).__name__))
            yield pd.DataFrame(out, columns=["response", "error"])

    done = pages.withColumn("_r", call.asNondeterministic()(F.col(image)))
    return done.withColumn("response", F.col("_r.response")).withColumn("error", F.col("_r.error")).drop("_r")


@F.pandas_udf(T.BinaryType())
def crop_png(raster: pd.Series, width: pd.Series, height: pd.Series, left: pd.Series, top: pd.Series, right: pd.Series, bottom: pd.Series) -> pd.Series:
    """PNG of a box of an RGB raster; outside the page is black. Null for an
    empty or inverted box and for rasters of another size."""
    import struct
    import zlib

    import numpy as np

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    def one(b: bytes, w: int, h: int, x0: int, y0: int, x1: int, y1: int) -> bytes | None:
        try:
            if b is None or x1 <= x0 or y1 <= y0 or len(b) != w * h * 3:
                return None
            page = np.frombuffer(b, np.uint8).reshape(int(h), int(w), 3)
            x0, y0, x1, y1 = int(x0), int(y0), int(x1), int(y1)
            out = np.zeros((y1 - y0, x1 - x0, 3), np.uint8)
            a, c, d, e = max(y0, 0), min(y1, int(h)), max(x0, 0), min(x1, int(w))
            if c > a and e > d:
                out[a - y0 : c - y0, d - x0 : e - x0] = page[a:c, d:e]
            rows = b"".join(b"\0" + r.tobytes() for r in out)
            return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", out.shape[1], out.shape[0], 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
        except (TypeError, ValueError):
            return None

    return pd.Series([one(*x) for x in zip(raster, width, height, left, top, right, bottom)])


def debug_rasters(pages: DataFrame) -> DataFrame:
    """(name, png): each page's whole raster, named by file and page."""
    png = crop_png("raster", "width_px", "height_px", F.lit(0), F.lit(0), "width_px", "height_px")
    name = F.concat(F.lit("debug_rasters/"), "exam_code", F.lit("/"), F.format_string("page_%04d.png", "page_number"))
    return pages.filter("raster IS NOT NULL").select(name.alias("name"), png.alias("png"))
