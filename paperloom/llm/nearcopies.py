"""Pairs and groups of records whose similarity reaches a threshold.

Fast similarity sketching: in round i every element of a record is hashed to a
random bin and keeps the smallest (round, hash) there; from round k on, round
k + j fills bin j from all elements, so every coordinate is filled after 2k
rounds at most, and a coordinate agrees between two records with a probability
equal to their Jaccard similarity, with Chernoff concentration. Runs of
``rows`` coordinates form bands; records that share a band are candidates,
which are verified on their whole element sets.

Records with the same elements and the same key are one class, sketched once;
links are made between class representatives and expanded to members at the
end only. Band entries travel packed: each task sorts its entries by band and
writes one blob per target partition, so an entry costs the bytes of its band
key and record key and nothing else. Bands of more than ``HOT`` records leave
the task that found them as pairs of blocks, which are expanded elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import release, stage

_EMPTY = np.uint32(0xFFFFFFFF)
_STEP, _TRIPLE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Bytes of an element where it is stored, and of a band key where it travels.
#: Two sets of 60 elements meet by chance in 5 bytes once in 3e8 pairs.
WIDE = 5
#: A band of more records is cut into blocks of so many.
HOT = 1_000
#: Band entries of one target partition, and target partitions of one pass.
PART_ROWS, PASS_PARTS = 2_000_000, 1 << 14


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * _STEP) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(256, dtype=np.uint64), 3)
_BASE = np.uint64(_TRIPLE)
_INVERSE = np.uint64(pow(_TRIPLE, -1, 1 << 64))


def _powers(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2 ** 64, by squaring."""
    out, e, b = np.ones(len(exponents), np.uint64), exponents.astype(np.int64), np.array([base], np.uint64)
    while len(e) and e.max() > 0:
        out *= np.where(e & 1, b, np.uint64(1))
        e, b = e >> 1, b * b
    return out


def _by_owner(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums (modulo 2 ** 64) of the runs between offsets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def hashed_words(texts: pa.Array, segment: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, length in bytes, offsets of rows) of the words of lower-case
    texts: maximal runs of letters, marks and digits. Null texts have none.

    A polynomial over the bytes, from running sums, cut into segments of whole
    words so that memory does not grow with a text.
    """
    texts = pc.fill_null(pc.replace_substring_regex(texts.cast(pa.large_string()), r"[^\p{L}\p{M}\p{N}]+", " "), "")
    row = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    b = np.frombuffer(raw, np.uint8)[row[0] : row[-1]] if raw is not None and len(row) and row[-1] > row[0] else np.zeros(0, np.uint8)
    row = row - row[0] if len(row) else np.zeros(1, np.int64)
    inside = b != 32
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = row[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(b))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        lo = 0
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + segment)))
            s, z = start[lo:hi] - start[lo], stop[lo:hi] - start[lo]
            part = b[start[lo] : stop[hi - 1]]
            up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(part) - 1, _BASE))])
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * up, dtype=np.uint64)])
            down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(part) - 1, _INVERSE))])
            out[lo:hi] = (total[z] - total[s]) * down[s]
            lo = hi
    return out, stop - start, np.searchsorted(start, row)


def _joined(words: np.ndarray, lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row the hash of its words written without space."""
    before = np.cumsum(lengths) - lengths
    origin = np.repeat(before[np.minimum(offsets[:-1], max(len(before) - 1, 0))] if len(before) else np.zeros(len(offsets) - 1, np.int64), np.diff(offsets))
    with np.errstate(over="ignore"):
        return _by_owner(words * _powers(_BASE, before - origin), offsets)


def _packed(values: np.ndarray) -> bytes:
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDE :].tobytes()


def unpacked(blob: np.ndarray) -> np.ndarray:
    """The values of a run of bytes, WIDE bytes each."""
    wide = np.zeros((len(blob) // WIDE, 8), np.uint8)
    wide[:, 8 - WIDE :] = blob.reshape(-1, WIDE)
    return wide.view(">u8").ravel().astype(np.uint64)


def element_sets(texts: pa.Array, options: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(d, c, sizes, elements) of records: a hash of the normalised record
    (options as a collection), a hash of its set of elements, and the distinct
    elements of all records one after the other."""
    n = len(texts)
    word, length, at = hashed_words(texts)
    h = _mix(word)
    with np.errstate(over="ignore"):
        runs = max(0, len(h) - width + 1)
        e = np.zeros(runs, np.uint64)
        for j in range(width):
            e = (e + h[j : j + runs]) * _BASE
        owner = np.repeat(np.arange(n), np.diff(at))
        whole = owner[:runs] == owner[width - 1 : width - 1 + runs]
        e, owner = _mix(e[whole], 5), owner[:runs][whole]
        own = pc.list_parent_indices(options).to_numpy(zero_copy_only=False).astype(np.int64)
        ow, ol, oat = hashed_words(pc.list_flatten(options))
        count = np.diff(oat)
        place = np.arange(len(ow)) - np.repeat(oat[:-1], count)
        joined = _mix(_by_owner(_mix(ow) * _powers(_BASE, place + 1), oat), 6)[count > 0]
        plain = _mix(_joined(ow, ol, oat), 8)[count > 0]
        own = own[count > 0]
        bag = np.concatenate([np.zeros(1, np.uint64), np.cumsum(plain, dtype=np.uint64)])[np.searchsorted(own, np.arange(n + 1))]
        d = _mix(_mix(_joined(word, length, at), 9) + (bag[1:] - bag[:-1]))
        # Records of a block have 20 bits, so a sort of one array orders the
        # elements of each record.
        key = np.concatenate([e, joined]) >> np.uint64(20) | np.concatenate([owner, own]).astype(np.uint64) << np.uint64(44)
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        owner, e = (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1)
        sizes = np.bincount(owner, minlength=n)
        c = _mix(_by_owner(_mix(e, 10), np.concatenate([[0], np.cumsum(sizes)])))
    return d, c, sizes, e >> np.uint64(44 - 8 * WIDE)


ELEMENTS = "k bigint, d bigint, c bigint, e binary"


def question_elements(df: DataFrame, key: str, text: str, options: str, width: int = 5) -> DataFrame:
    """(k, d, c, e) of the records that have elements: the key, a hash of the
    normalised record, a hash of the set, and the distinct elements, sorted,
    WIDE bytes each. Elements are the runs of ``width`` consecutive words of
    the text and each option as a whole, kept apart from the runs. Null keys,
    and texts that are null or have no letter or digit, are no cases."""
    none = F.array().cast("array<string>")
    lower = F.transform(F.coalesce(F.col(options), none), lambda o: F.lower(F.coalesce(o, F.lit(""))))
    base = df.select(F.col(key).cast("bigint").alias("k"), F.lower(F.col(text)).alias("t"), lower.alias("o"))
    base = base.filter(F.col("t").rlike(r"[\p{L}\p{N}]") & F.col("k").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4_000):
                b = whole.slice(lo, 4_000)
                d, c, sizes, e = element_sets(b.column(1), b.column(2), width)
                at = np.concatenate([[0], np.cumsum(sizes * WIDE)])
                if at[-1] >= 1 << 31:
                    raise ValueError("a block of records has elements of more than 2 GB")
                sets = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(_packed(e))])
                out = pa.RecordBatch.from_arrays([b.column(0), pa.array(d.view(np.int64)), pa.array(c.view(np.int64)), sets], names=["k", "d", "c", "e"])
                yield out.filter(pa.array(sizes > 0))

    return base.mapInArrow(run, ELEMENTS)


def sketches(elements: np.ndarray, sizes: np.ndarray, bins: int, seed: int = 1) -> np.ndarray:
    """(records, bins) array of coordinates. ``elements``: hashes of all
    records one after the other; every size is at least 1. A coordinate holds
    its round and 20 bits of hash; one hash serves two rounds."""
    n = len(sizes)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    out = np.full(n * bins, _EMPTY)
    el = elements.astype(np.uint64)
    for i in range(2 * bins):
        if i % 2 == 0:
            h = _mix(el, seed * 1_000_003 + i)
        half = (h >> np.uint64(32 * (i % 2))).astype(np.uint32)
        at = owner * bins + ((half & np.uint32(0xFFF)).astype(np.int64) * bins >> 12 if i < bins else i - bins)
        # Values of a later round are larger, so only empty bins can change.
        free = out[at] == _EMPTY
        np.minimum.at(out, at[free], (half[free] >> np.uint32(12)) | np.uint32(i << 20))
        if i % 4 == 3:
            open_ = (out.reshape(n, bins) == _EMPTY).any(axis=1)
            if not open_.any():
                break
            stay = open_[owner]
            if stay.mean() < 0.7:
                el, owner, h = el[stay], owner[stay], h[stay]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(records, bands) 64-bit keys."""
    with np.errstate(over="ignore"):
        parts = sketch[:, : bands * rows].astype(np.uint64).reshape(len(sketch), bands, rows)
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
        for r in range(rows):
            key = _mix(key ^ parts[:, :, r], r + 11)
    return key


def plan_bands(threshold: float, rows: int, miss: float) -> int:
    """Bands needed so that a pair just at the threshold is missed with at
    most probability ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The bytes of the values, all first bytes first: equal high bytes
    compress to nothing."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes()


def _unplaned(blob: memoryview, width: int) -> np.ndarray:
    n = len(blob) // width
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 8 - width :] = np.frombuffer(blob, np.uint8).reshape(width, n).T
    return wide.view(">u8").ravel()


def _band_blobs(reps: DataFrame, bands: int, rows: int, seed: int, parts: int, block: int = 2_000, flush: int = 1_000_000) -> DataFrame:
    """(part, bands, ks): packed entries of one task for one target."""

    def packed(keys: list[np.ndarray], ks: list[np.ndarray]) -> pa.RecordBatch:
        key, k = np.concatenate(keys), np.concatenate(ks)
        part = (key >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)
        key = part << np.uint64(8 * WIDE) | key & np.uint64((1 << 8 * WIDE) - 1)
        order = np.argsort(key)
        key, k, part = key[order], k[order], part[order]
        at = np.concatenate([np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), [len(part)]])
        # Differences of sorted keys: the more entries, the fewer bytes each.
        low = np.diff(key, prepend=np.uint64(0))
        low[at[:-1]] = key[at[:-1]] & np.uint64((1 << 8 * WIDE) - 1)
        spans = list(zip(at[:-1], at[1:]))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[at[:-1]].astype(np.int32)), pa.array([_planes(low[a:z], WIDE) for a, z in spans], pa.binary()), pa.array([_planes(k[a:z], 8) for a, z in spans], pa.binary())], names=["part", "bands", "ks"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ks, held = [], [], 0
        for whole in batches:
            for lo in range(0, whole.num_rows, block):
                batch = whole.slice(lo, block)
                sets = batch.column(1)
                off = np.frombuffer(sets.buffers()[1], np.int32)[sets.offset : sets.offset + len(sets) + 1].astype(np.int64)
                el = unpacked(np.frombuffer(sets.buffers()[2], np.uint8)[off[0] : off[-1]])
                key = band_keys(sketches(el, np.diff(off) // WIDE, bands * rows, seed), bands, rows)
                keys.append(key.ravel())
                ks.append(np.repeat(batch.column(0).to_numpy(), bands))
                held += key.size
                if held >= flush:
                    yield packed(keys, ks)
                    keys, ks, held = [], [], 0
        if held:
            yield packed(keys, ks)

    return reps.select("k", "e").mapInArrow(run, "part int, bands binary, ks binary")


FOUND = "a bigint, b bigint, lefts binary, rights binary"


def _pairs_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct unordered pairs of different keys as rows of FOUND."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = low != high
    if len(low):
        new[1:] &= (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    none = pa.nulls(int(new.sum()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(high[new]), none, none], names=["a", "b", "lefts", "rights"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the records of each band of a partition; a hot band as pairs
    of blocks. Groups of pairs are emitted as they fill a batch."""
    bands, ks = [], []
    for batch in batches:
        for x, y in zip(batch.column(1), batch.column(2)):
            bands.append(np.cumsum(_unplaned(memoryview(x.as_buffer()), WIDE), dtype=np.uint64))
            ks.append(_unplaned(memoryview(y.as_buffer()), 8).astype(np.int64))
    if not bands:
        return
    key, k = np.concatenate(bands), np.concatenate(ks)
    del bands, ks
    order = np.argsort(key)
    key, k = key[order], k[order]
    del order
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([start, [len(key)]]))
    a, b, held = [], [], 0
    for m in np.unique(size[(size > 1) & (size <= HOT)]):
        i, j = np.triu_indices(int(m), 1)
        of = start[size == m]
        step = max(1, 500_000 // len(i))
        for lo in range(0, len(of), step):
            group = k[of[lo : lo + step, None] + np.arange(m)]
            a.append(group[:, i].ravel())
            b.append(group[:, j].ravel())
            held += a[-1].size
            if held >= 1_000_000:
                yield _pairs_of(np.concatenate(a), np.concatenate(b))
                a, b, held = [], [], 0
    if held:
        yield _pairs_of(np.concatenate(a), np.concatenate(b))
    for s, m in zip(start[size > HOT], size[size > HOT]):
        blocks = [np.sort(k[lo : min(lo + HOT, s + m)]).tobytes() for lo in range(s, s + m, HOT)]
        for i, left in enumerate(blocks):
            for lo in range(i, len(blocks), 100):
                rights = blocks[lo : lo + 100]
                nones = pa.nulls(len(rights), pa.int64())
                yield pa.RecordBatch.from_arrays([nones, nones, pa.array([left] * len(rights), pa.binary()), pa.array(rights, pa.binary())], names=["a", "b", "lefts", "rights"])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs between two blocks."""
    for batch in batches:
        for x, y in zip(batch.column(2), batch.column(3)):
            left, right = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            yield _pairs_of(np.repeat(left, len(right)), np.tile(right, len(left)))


def candidate_pairs(reps: DataFrame, n: int, threshold: float, rows: int, miss: float) -> DataFrame:
    """Distinct (a, b), a < b, of representatives that share a band, staged.
    ``n``: number of representatives, which decides partitions and passes;
    each pass makes its own share of the bands."""
    bands = plan_bands(threshold, rows, miss)
    passes = max(1, math.ceil(n * bands / (PART_ROWS * PASS_PARTS)))
    each = math.ceil(bands / passes)
    least = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, math.ceil(n * each / PART_ROWS))
    raws, out = [], None
    for i in range(passes):
        blobs = _band_blobs(reps, each, rows, i + 1, parts)
        raw = stage(blobs.repartitionById(parts, "part").mapInArrow(_meet, FOUND), f"near-{i}")
        raws.append(raw)
        hot = raw.filter("a IS NULL").repartition("lefts", "rights").mapInArrow(_expand, FOUND)
        found = raw.filter("a IS NOT NULL").unionByName(hot).select("a", "b")
        out = found if out is None else out.unionByName(found)
    pairs = stage(out.distinct(), "near-pairs")
    release(*raws)
    return pairs


def verified(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs that reach the threshold, counted on their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 5_000):
                batch = whole.slice(lo, 5_000)
                values, owners, total = [], [], np.zeros(batch.num_rows)
                for sets in (batch.column(2), batch.column(3)):
                    off = np.frombuffer(sets.buffers()[1], np.int32)[sets.offset : sets.offset + len(sets) + 1].astype(np.int64)
                    size = np.diff(off) // WIDE
                    values.append(unpacked(np.frombuffer(sets.buffers()[2], np.uint8)[off[0] : off[-1]]))
                    owners.append(np.repeat(np.arange(len(size), dtype=np.uint64), size))
                    total += size
                key = np.concatenate(owners) << np.uint64(8 * WIDE) | np.concatenate(values)
                key.sort()
                twice = key[1:][key[1:] == key[:-1]] >> np.uint64(8 * WIDE)
                common = np.bincount(twice.astype(np.int64), minlength=batch.num_rows)
                yield batch.select(["a", "b"]).filter(pa.array(common >= threshold * (total - common)))

    a = reps.select(F.col("k").alias("a"), F.col("e").alias("ea"))
    b = reps.select(F.col("k").alias("b"), F.col("e").alias("eb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ea", "eb").mapInArrow(run, "a bigint, b bigint")


def similar_classes(df: DataFrame, elements: Callable[[DataFrame], DataFrame], threshold: float, rows: int, miss: float) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (a, b) between the representatives of classes
    of records with the same elements and the same ``d``, and the classes as
    (k, rep, d), one row a record."""
    base = stage(elements(df), "near-elements")
    heads = base.groupBy("c", "d").agg(F.min("k").alias("rep"))
    members = stage(base.select("k", "c", "d").join(heads, ["c", "d"]).select("k", "rep", "d"), "near-members")
    copies = members.filter("k <> rep").select("k")
    reps = base.join(copies, "k", "left_anti")
    pairs = candidate_pairs(reps, members.filter("k = rep").count(), threshold, rows, miss)
    return verified(pairs, base, threshold), members


def similar_pairs(df: DataFrame, elements: Callable[[DataFrame], DataFrame], threshold: float = 0.8, rows: int = 4, miss: float = 0.02) -> DataFrame:
    """(uid_a, uid_b), uid_a < uid_b: records of similarity >= threshold
    whose ``d`` differs. elements: from rows of ``df`` to (k, d, c, e);
    records without elements are no cases; keys are expected to be unique."""
    links, members = similar_classes(df, elements, threshold, rows, miss)
    of_a = members.select(F.col("rep").alias("a"), F.col("k").alias("ka"), F.col("d").alias("da"))
    of_b = members.select(F.col("rep").alias("b"), F.col("k").alias("kb"), F.col("d").alias("db"))
    every = links.join(of_a, "a").join(of_b, "b").filter("da <> db")
    return every.select(F.least("ka", "kb").alias("uid_a"), F.greatest("ka", "kb").alias("uid_b"))


def components(links: DataFrame) -> DataFrame:
    """(k, root): the connected component of each key of ``links`` (a, b),
    named by its smallest key.

    Large-star and small-star rounds: each key's larger neighbours, then its
    smaller ones, are tied to the smallest of its neighbourhood, until nothing
    changes. Each star is one aggregate and one join with one row per key on
    the other side; no component is gathered anywhere.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        tied = both.join(least, "a")
        if large:
            return tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        return tied.select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.filter("a <> m").select("a", F.col("m").alias("b"))).distinct()

    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "star")
    sign = None
    while True:
        new = stage(star(star(edges, True), False), "star")
        release(edges)
        at = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        edges = new
        if at == sign:
            break
        sign = at
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("k"), "root")
    return roots.unionByName(edges.select(F.col("b").alias("k"), F.col("b").alias("root")).distinct())


def similar_groups(df: DataFrame, elements: Callable[[DataFrame], DataFrame], threshold: float = 0.8, rows: int = 4, miss: float = 0.02, key: str = "k") -> DataFrame:
    """(key, group_uid, n_records): the records that have a similar record,
    each with the smallest key of its group and the group's size. Groups are
    the connected components of the pairs of ``similar_pairs``; they are found
    on class representatives and brought to the members."""
    links, members = similar_classes(df, elements, threshold, rows, miss)
    ds = members.filter("k = rep").select("rep", "d")
    real = links.join(ds.select(F.col("rep").alias("a"), F.col("d").alias("da")), "a").join(ds.select(F.col("rep").alias("b"), F.col("d").alias("db")), "b").filter("da <> db")
    roots = components(real.select("a", "b"))
    rows_ = stage(members.join(roots.withColumnRenamed("k", "rep"), "rep").select("k", "root"), "near-groups")
    sizes = rows_.groupBy("root").agg(F.min("k").alias("group_uid"), F.count("*").alias("n_records"))
    return rows_.join(sizes, "root").select(F.col("k").alias(key), "group_uid", "n_records")
