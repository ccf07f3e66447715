"""Records that are the same apart from formatting.

Progressive refinement in three steps. The first scan gives each record an
invariant that costs one pass over its bytes: the histogram of its letters and
digits, of the text and of all options together, so that case, space,
punctuation and the order of options don't matter; only counts of invariants
are shuffled. The second scan computes the costly key (a digest of the
normalised text and the sorted normalised options) for records whose invariant
occurs several times; a bit filter of bounded size tells which (its false
positives cost a digest and change nothing). Only keys and digests of those
records are shuffled, never texts, and only digests with several members
become classes. Every grouping combines before its shuffle; the join that
brings a class's head back has one row per class on the other side, so
adaptive skew splitting applies to a class of a third of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stage
from . import filters
from .nearcopies import _mix

_WEIGHT = _mix(np.arange(256, dtype=np.uint64), 21)
_WEIGHT[[b for b in range(256) if not (b < 128 and chr(b).isalnum())]] = 0
_NOISE = r"[^\p{L}\p{M}\p{N}]+"


def _histograms(texts: pa.Array) -> np.ndarray:
    """Per text a weighted count of its ASCII letters and digits (modulo
    2 ** 64): equal for equal histograms, whatever the order."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    out = np.zeros(len(texts), np.uint64)
    b = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo, most = 0, 1 << 22
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        if hi == lo + 1:  # a text of any length, piece by piece
            for piece in range(at[lo], at[hi], most):
                out[lo] += _WEIGHT[b[piece : min(piece + most, at[hi])]].sum(dtype=np.uint64)
        else:
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_WEIGHT[b[at[lo] : at[hi]]], dtype=np.uint64)])
            edges = total[at[lo : hi + 1] - at[lo]]
            out[lo:hi] = edges[1:] - edges[:-1]
        lo = hi
    return out


def invariants(texts: pa.Array, options: pa.Array) -> np.ndarray:
    """64-bit invariants of records of lower-case texts and options."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_histograms(pc.fill_null(pc.list_flatten(options), "")), dtype=np.uint64)])
    own = pc.list_parent_indices(options).to_numpy(zero_copy_only=False)
    at = np.searchsorted(own, np.arange(len(texts) + 1))
    with np.errstate(over="ignore"):
        return _mix(_mix(_histograms(texts), 22) + (sums[at[1:]] - sums[at[:-1]]), 23)


def costly_keys(texts: pa.Array, options: pa.Array) -> list[bytes]:
    """128-bit digests of the normalised texts and the sorted normalised
    options; options that are null or have no letter or digit are left out."""
    plain = pc.replace_substring_regex(texts, _NOISE, "").to_pylist()
    flat = pc.replace_substring_regex(pc.fill_null(pc.list_flatten(options), ""), _NOISE, "").to_pylist()
    own = pc.list_parent_indices(options).to_numpy(zero_copy_only=False)
    at = np.searchsorted(own, np.arange(len(texts) + 1))
    out = []
    for t, a, z in zip(plain, at[:-1], at[1:]):
        whole = "\n".join([t, *sorted(o for o in flat[a:z] if o)])
        out.append(hashlib.blake2b(whole.encode(), digest_size=16).digest())
    return out


def copy_classes(df: DataFrame, key: str, text: str, options: str) -> DataFrame:
    """(key, first, n): for each record of a class of several records, its
    class's smallest key and number of records.

    Records whose text is null or has no letter or digit are no cases. Equal
    keys that occur twice count as two records. Extra columns are ignored.
    """
    none = F.array().cast("array<string>")
    base = df.select(F.col(key).alias("k"), F.lower(F.col(text)).alias("t"), F.transform(F.coalesce(F.col(options), none), F.lower).alias("o"))
    base = base.filter(F.col("t").rlike(r"[\p{L}\p{N}]"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(invariants(b.column(0), b.column(1)).view(np.int64))], names=["c"])

    several = base.select("t", "o").mapInArrow(first, "c bigint").groupBy("c").agg(F.count("*").alias("n")).filter("n > 1")
    shared = df.sparkSession.sparkContext.broadcast(filters.build(several, "c"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            some = b.filter(pa.array(filters.passes(table, invariants(b.column(1), b.column(2)))))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(costly_keys(some.column(1), some.column(2)), pa.binary())], names=["k", "d"])

    kind = df.schema[key].dataType.simpleString()
    keyed = stage(base.select("k", "t", "o").mapInArrow(second, f"k {kind}, d binary"), "copies")
    heads = keyed.groupBy("d").agg(F.min("k").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return keyed.join(heads, "d").select(F.col("k").alias(key), "first", "n")
