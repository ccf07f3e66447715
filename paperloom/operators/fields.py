"""Fields that hold several values: one row per value, position kept.

The values of a batch are read as one UTF-8 byte buffer.  Quote parity,
bracket depth and delimiter masks are computed over the whole buffer with
numpy; runs of bytes that belong to no delimiter become the items, whose
offsets build an Arrow list array that is flattened with its parent ordinals.
Only rows in which a *choice* of the row (an option of the question) holds a
delimiter itself, or a number is ambiguous, are looked at one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Single-byte separators; separators of three bytes in UTF-8;
#: separators that need a space on both sides.
BYTE_SEPARATORS = b",;|\n\r\t"
WIDE_SEPARATORS = ("、", "；", "，", "｜")
SPACED_SEPARATORS = (" and ", " or ", " & ", " + ", " - ", " – ", " / ")
BRACKETS = (("(", ")"), ("[", "]"), ("{", "}"))
QUOTES = (('"', '"'), ("“", "”"), ("«", "»"), ("‘", "’"), ("'", "'"))

_WORD = re.compile(r"[^\W_]+")


def _next(mask: np.ndarray, by: int = 1) -> np.ndarray:
    """mask as seen ``by`` bytes later (out[i] = mask[i + by])."""
    out = np.zeros_like(mask)
    out[:-by] = mask[by:]
    return out


def _prev(mask: np.ndarray, by: int = 1) -> np.ndarray:
    out = np.zeros_like(mask)
    out[by:] = mask[:-by]
    return out


def _find(b: np.ndarray, what: bytes) -> np.ndarray:
    """Mask of the first bytes of every occurrence of ``what``."""
    hit = b == what[0]
    for k, c in enumerate(what[1:], 1):
        hit &= _next(b == c, k)
    return hit


def _spread(first: np.ndarray, width: int) -> np.ndarray:
    out = first.copy()
    for k in range(1, width):
        out |= _prev(first, k)
    return out


def _row_sums(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Running sum of x that starts anew at each row."""
    total = np.concatenate([[0], np.cumsum(x)])
    return total[1:] - np.repeat(total[off[:-1]], np.diff(off))


def _runs_before(mask: np.ndarray) -> np.ndarray:
    """Length of the run of mask that ends just before each byte."""
    n = len(mask)
    at = np.arange(n)
    last_off = np.maximum.accumulate(np.where(mask, -1, at))
    run = np.where(mask, at - last_off, 0)
    return np.concatenate([[0], run[:-1]]) if n else run


def delimiter_mask(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes that belong to delimiters or enclosing brackets, inside-quotes
    mask, positions of ambiguous number separators) of rows ``off`` of ``b``.

    Every row is trimmed, not empty and followed by one NUL byte, which counts
    as a delimiter and keeps the rows apart for the masks of neighbours.
    """
    n, rows = len(b), len(off) - 1
    lengths = np.diff(off)
    start, end = off[:-1], off[1:] - 1
    first, last = b[start], b[end - 1]
    is_space = (b == 32) | (b == 9) | (b == 10) | (b == 13)
    delim = np.zeros(n, bool)
    delim[end] = True

    # Brackets that enclose the whole row: depth stays above 0 until the end.
    opened = np.zeros(rows, bool)
    for left, right in ((40, 41), (91, 93), (123, 125)):
        row = (first == left) & (last == right) & (lengths > 2)
        if row.any():
            depth = _row_sums((b == left).astype(np.int32) - (b == right), off)
            depth[end - 1] = 1
            depth[end] = 1
            row &= np.minimum.reduceat(depth, start) >= 1
            opened |= row
    delim[start[opened]] = True
    delim[end[opened] - 1] = True

    # Quote parity by kind. A quote opens where an item may start and closes
    # where one may end; a kind counts in rows where its marks pair up, so an
    # apostrophe or a sign of inches is a letter like others.
    escaped = _prev(b == 92)
    row_start = np.zeros(n, bool)
    row_start[start] = True
    separator = np.isin(b, np.frombuffer(BYTE_SEPARATORS + b"/&+-", np.uint8)) | np.isin(b, np.frombuffer(b"()[]{}", np.uint8))
    for wide in WIDE_SEPARATORS:
        separator |= _spread(_find(b, wide.encode()), 3)
    edge = is_space | delim | separator
    may_open, may_close = (_prev(edge) | row_start) & ~escaped, _next(edge) & ~escaped
    inside = np.zeros(n, bool)
    for left, right in QUOTES:
        x, y = left.encode(), right.encode()
        first = _find(b, x) & ~inside
        if not first.any():
            continue
        if left == right:
            # A doubled mark inside quotes is one mark of the value: it turns
            # the parity twice.
            doubled = _spread(first & _next(first), 2) & ~escaped
            mark = first & ~escaped & (may_open | may_close | doubled)
            parity = _row_sums(mark.astype(np.int32), off)
            # Opening marks must be able to open, closing ones to close.
            opening = mark & (parity % 2 == 1)
            wrong = ((opening & ~may_open) | (mark & ~opening & ~may_close)) & ~doubled
            good = (parity[end - 1] % 2 == 0) & (np.add.reduceat(wrong.astype(np.int32), start) == 0)
            inside |= (parity % 2 == 1) & np.repeat(good, lengths)
        else:
            last = _find(b, y) & ~inside
            # An apostrophe looks like a closing mark: it closes only before
            # an edge.
            last &= _next(edge | (b == 0), len(y))
            depth = _row_sums(first.astype(np.int32) - last, off)
            good = (depth[end - 1] == 0) & (np.minimum.reduceat(depth, start) >= 0)
            inside |= (depth > 0) & np.repeat(good, lengths)

    # Brackets around one item of several keep it whole; those that follow a
    # letter or digit (a function, an interval) keep their content whole too.
    for left, right in ((40, 41), (91, 93), (123, 125)):
        opening, closing = (b == left) & ~inside & ~delim, (b == right) & ~inside & ~delim
        if opening.any():
            depth = _row_sums(opening.astype(np.int32) - closing, off)
            good = (depth[end - 1] == 0) & (np.minimum.reduceat(depth, start) >= 0)
            inside |= (depth > 0) & np.repeat(good, lengths)

    digit = (b >= 48) & (b <= 57)
    letter = ((b | 32) >= 97) & ((b | 32) <= 122)
    free = ~inside

    # A thousands comma: one to three digits before, exactly three after.
    comma = b == 44
    run = _runs_before(digit)
    head = np.arange(n) - run - 1
    before_run = np.where(head >= np.repeat(start, lengths), b[np.maximum(head, 0)], 32)
    three = _next(digit) & _next(digit, 2) & _next(digit, 3) & ~_next(digit, 4)
    grouped = comma & (run >= 1) & (run <= 3) & three & (before_run != 46)
    # A fraction bar between digits; a bar inside the unit of a number.
    slash = b == 47
    fraction = slash & _prev(digit) & _next(digit)
    lrun = _runs_before(letter)
    unit_head = np.arange(n) - lrun - 1
    row_of_start = np.repeat(start, lengths)
    gap = np.where(unit_head >= row_of_start, b[np.maximum(unit_head, 0)], 0)
    figure = np.where(unit_head - 1 >= row_of_start, b[np.maximum(unit_head - 1, 0)], 0)
    unit = slash & (lrun >= 1) & _next(letter) & (((gap == 32) & (figure >= 48) & (figure <= 57)) | ((gap >= 48) & (gap <= 57)))

    plain = np.isin(b, np.frombuffer(BYTE_SEPARATORS, np.uint8)) & ~grouped
    delim |= (plain | (slash & ~fraction & ~unit)) & free
    for wide in WIDE_SEPARATORS:
        w = wide.encode()
        delim |= _spread(_find(b, w) & free, len(w))
    folded = np.where((b >= 65) & (b <= 90), b | 32, b)
    flat = np.where(is_space, np.uint8(32), folded)
    for word in SPACED_SEPARATORS:
        w = word.encode()
        delim |= _spread(_find(flat, w) & free, len(w))
    two = (b == 32) & _next(b == 32) & free
    delim |= _spread(two, 2)
    # A space between single letters separates where a row has letters only.
    lone = letter & ~_prev(letter | digit | (b > 127)) & ~_next(letter | digit | (b > 127))
    other = ~(lone | is_space | delim | np.isin(b, np.frombuffer(b"&+-/\"'", np.uint8)))
    only = np.add.reduceat(other.astype(np.int32), start) == 0
    delim |= is_space & free & np.repeat(only, lengths)
    return delim, inside, (grouped | fraction) & free


def _norm(s: str) -> str:
    return " ".join(_WORD.findall(s.lower()))


def _resolve(text: str, options: list[str], delim: np.ndarray, unsure: np.ndarray) -> None:
    """Decide by the options of a row: keep an option whole; split a number at
    a comma or bar where only its parts are options. Changes ``delim``."""
    raw = text.encode()
    names = {_norm(o) for o in options if o}
    for o in options:
        words = _WORD.findall((o or "").lower())
        if len(words) < 2 or not re.search(r"[,;|/+&-]|\s(?:and|or)\s", o):
            continue
        pattern = r"(?<![^\W_])" + r"[\W_]+".join(map(re.escape, words)) + r"(?![^\W_])"
        for m in re.finditer(pattern, text, re.I):
            a, z = len(text[: m.start()].encode()), len(text[: m.end()].encode())
            if delim[a:z].any():
                delim[a:z] = False
    if unsure.any():
        exact = {re.sub(r"\s+", " ", (o or "").strip().lower()) for o in options}
        at = np.flatnonzero(unsure)
        edges = np.flatnonzero(delim)
        for i in at:
            lo = edges[edges < i].max(initial=-1) + 1
            hi = edges[edges > i].min(initial=len(raw))
            whole = raw[lo:hi].decode(errors="replace").strip().lower()
            near = [raw[lo:i], raw[i + 1 : hi]]
            parts = [p.strip().lower() for x in near for p in re.split(r"[,/]", x.decode(errors="replace"))]
            if whole not in exact and all(p in exact or _norm(p) in names for p in parts):
                delim[i] = True


def _unwrap(values: pa.Array) -> pa.Array:
    """Trim; take off enclosing brackets and quotes; undo escapes."""
    values = pc.utf8_trim_whitespace(values)
    for left, right in BRACKETS:
        values = pc.replace_substring_regex(values, rf"(?s)^\{left}([^\{left}\{right}]*)\{right}$", r"\1")
    values = pc.utf8_trim_whitespace(values)
    for left, right in QUOTES[1:4]:
        values = pc.replace_substring_regex(values, rf"(?s)^{left}\s*([^{left}]*?)\s*{right}$", r"\1")
    for q in ('"', "'"):
        quoted = pc.match_substring_regex(values, rf"(?s)^{q}.*{q}$")
        quoted = pc.and_(quoted, pc.greater(pc.utf8_length(values), 1))
        if not pc.any(quoted).as_py():
            continue
        inner = pc.utf8_slice_codeunits(values, 1, -1)
        inner = pc.replace_substring(inner, q + q, q) if q == '"' else inner
        inner = pc.replace_substring_regex(inner, r"""\\(["'\\])""", r"\1")
        values = pc.if_else(quoted, pc.utf8_trim_whitespace(inner), values)
    return values


def split_values(values: pa.Array, choices: pa.Array | None = None) -> pa.ListArray:
    """One list of values per row; null and blank rows give empty lists.

    ``choices`` (a list of strings per row, or null) names values that are to
    stay whole although they hold a separator.
    """
    values = pc.fill_null(pc.utf8_trim_whitespace(pa.array(values, pa.string()) if not isinstance(values, pa.Array) else values.cast(pa.string())), "")
    total = len(values)
    live = pc.greater(pc.binary_length(values), 0)
    rows = np.flatnonzero(live.to_numpy(zero_copy_only=False))
    if not len(rows):
        return pa.ListArray.from_arrays(pa.array(np.zeros(total + 1, np.int32)), pa.array([], pa.string()))
    trimmed = values.filter(live)
    text = pc.binary_join_element_wise(trimmed, "", "\0")
    off = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    b = np.frombuffer(text.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    delim, _, unsure = delimiter_mask(b, off)
    if choices is not None:
        # Only rows of several parts whose options hold a separator themselves,
        # or whose numbers are ambiguous, are looked at one by one.
        doubtful = np.add.reduceat(unsure.astype(np.int32), off[:-1]) > 0
        several = np.add.reduceat(delim.astype(np.int32), off[:-1]) > 1
        own = choices.take(pa.array(rows)).cast(pa.list_(pa.string()))
        packed = pc.fill_null(pc.match_substring_regex(pc.list_flatten(own), r"(?i)[,;|/+&、；，｜–-]|\s(?:and|or)\s|\s\s|^\s*\S(?:\s+\S)+\s*$"), False).to_numpy(zero_copy_only=False)
        holds = np.bincount(pc.list_parent_indices(own).to_numpy()[packed], minlength=len(rows)) > 0
        check = np.flatnonzero(doubtful | (several & holds))
        own = own.take(pa.array(check)).to_pylist()
        whole = trimmed.take(pa.array(check)).to_pylist()
        for k, t, options in zip(check, whole, own):
            if options:
                if len(t) > 1 and _norm(t) and " " in _norm(t) and not t[0].isdigit() and _norm(t) in {_norm(o) for o in options if o}:
                    delim[off[k] : off[k + 1] - 1] = False
                    continue
                _resolve(t, options, delim[off[k] : off[k + 1] - 1], unsure[off[k] : off[k + 1] - 1])
    # Items are the runs of bytes outside delimiters.
    keep = ~delim
    begin = keep.copy()
    begin[1:] &= delim[:-1]
    stop = keep.copy()
    stop[:-1] &= delim[1:]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    parent = np.searchsorted(off, starts, side="right") - 1
    # Gather the kept bytes: child offsets are the running item lengths.
    child = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    items = pa.StringArray.from_buffers(len(starts), pa.py_buffer(child.tobytes()), pa.py_buffer(b[keep].tobytes()))
    items = _unwrap(items)
    full = pc.greater(pc.binary_length(items), 0).to_numpy(zero_copy_only=False)
    items, parent = items.filter(pa.array(full)), rows[parent[full]]
    counts = np.bincount(parent, minlength=total)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), items)


def split_packed_field(df: DataFrame, key: str, field: str, choices: str | None = None, pos: str = "pos", value: str = "value") -> DataFrame:
    """One row (key, pos, value) per value packed in ``field``.

    Null and blank fields, and fields of separators only, give no row; empty
    places aren't counted. Other columns of ``df`` are ignored, whatever their
    names. Narrow: no shuffle, memory bounded by the Arrow batch.
    """
    kind = df.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField(pos, T.IntegerType()), T.StructField(value, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_values(batch.column(1), batch.column(2) if batch.num_columns > 2 else None)
            parent = pc.list_parent_indices(lists)
            at = lists.offsets.to_numpy()
            p = parent.to_numpy()
            order = (np.arange(len(p)) - at[p]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(parent), pa.array(order), lists.flatten()], names=[key, pos, value])

    cols = [F.col(key), F.col(field), *([F.col(choices)] if choices else [])]
    return df.select(*cols).filter(F.col(field).rlike(r"\S")).mapInArrow(run, out)
