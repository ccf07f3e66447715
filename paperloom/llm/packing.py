"""Filling containers of fixed capacity with items of varying length.

Bounded-space online best fit: a task keeps at most ``open_bins`` open
containers; a bit set has one bit for each amount of free space that some open
container has, so the fullest container that still takes an item is the lowest
set bit at or above the item's size. An item that fits nowhere opens a new
container; if all are open, the fullest closes first. The containers that are
still open at the end of a task are packed once more, largest first and as
whole units, by far fewer tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stage
from .tokenise import DEFAULT_VOCABULARY, Encoder, read_ranks, serialise_model

#: Containers left open by the tasks that one task of the second pass takes.
SECOND_PASS = 8_192


class BestFit:
    """Places sizes one by one. ``place`` gives (container, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.bits = 0
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.n_open = self.n_bins = 0

    def _push(self, bin_: int, free: int) -> None:
        self.by_free[free].append(bin_)
        self.bits |= 1 << free

    def _pop(self, free: int) -> int:
        bins = self.by_free[free]
        out = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return out

    def place(self, size: int) -> tuple[int, int]:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = self._pop(free)
        else:
            if self.n_open >= self.limit:
                self._pop((self.bits & -self.bits).bit_length() - 1)
                self.n_open -= 1
            bin_, free = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        if free > size:
            self._push(bin_, free - size)
        else:
            self.n_open -= 1
        return bin_, self.capacity - free

    def still_open(self) -> list[int]:
        return [b for bins in self.by_free.values() for b in bins]


COLUMNS = "doc_id bigint, piece int, start_token int, n_tokens int, bin_id bigint, bin_offset int, is_open boolean"


def _first_pass(sizes: Callable[[], Callable[[pa.RecordBatch], list[int]]], capacity: int, open_bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "piece", "start_token", "n_tokens", "bin_id", "bin_offset", "is_open"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_of, fit = sizes(), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}  # rows of containers that may still be open

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                done: list[tuple] = []
                for doc, n in zip(batch.column(0).to_pylist(), size_of(batch)):
                    if n == 0:
                        done.append((doc, 0, 0, 0, None, None, False))
                    for piece, at in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - at)
                        bin_, offset = fit.place(size)
                        held.setdefault(bin_, []).append((doc, piece, at, size, base + bin_, offset))
                open_now = set(fit.still_open())
                for bin_ in [b for b in held if b not in open_now]:
                    done += [(*r, False) for r in held.pop(bin_)]
                yield emit(done)
        yield emit([(*r, True) for rows in held.values() for r in rows])

    return run


def _second_pass(capacity: int, open_bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, base = BestFit(capacity, open_bins), (1 << 62) | (TaskContext.get().partitionId() << 32)
        for batch in batches:
            placed = [fit.place(n) for n in batch.column(1).to_pylist()]
            to, shift = [base + b for b, _ in placed], [o for _, o in placed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to, pa.int64()), pa.array(shift, pa.int32())], names=["bin_id", "to_bin", "shift"])

    return run


def pack(df: DataFrame, key: str, sized: Callable[[], Callable[[pa.RecordBatch], list[int]]], columns: list[str], capacity: int, open_bins: int = 128) -> DataFrame:
    """One row per piece of an item: doc_id, piece, start_token, n_tokens,
    bin_id, bin_offset.

    Items of size 0 come out once with a null container. Only an item larger
    than the capacity is cut (into full pieces and a rest). A container
    belongs to one task; container ids are unique. Ties go to the container
    that reached the free space last.
    """
    items = df.select(F.col(key).cast("bigint"), *[F.col(c) for c in columns])
    first = stage(items.mapInArrow(_first_pass(sized, capacity, open_bins), COLUMNS), "packed")
    loose = first.filter("is_open")
    tasks = max(1, math.ceil(items.rdd.getNumPartitions() * open_bins / SECOND_PASS))
    fill = loose.groupBy("bin_id").agg(F.sum("n_tokens").cast("int").alias("fill"))
    moved = fill.repartition(tasks, "bin_id").sortWithinPartitions(F.desc("fill"), "bin_id").mapInArrow(_second_pass(capacity, open_bins), "bin_id bigint, to_bin bigint, shift int")
    moved = stage(moved, "packed-rest")
    kept = first.filter("NOT is_open").drop("is_open")
    joined = loose.join(moved, "bin_id").select("doc_id", "piece", "start_token", "n_tokens", F.col("to_bin").alias("bin_id"), (F.col("bin_offset") + F.col("shift")).alias("bin_offset"))
    return kept.unionByName(joined)


def pack_texts(df: DataFrame, key: str, text: str, capacity: int = 2_048, open_bins: int = 128, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``pack`` of texts, measured in tokens of the vocabulary; texts are
    encoded and packed in one narrow pass."""
    model = serialise_model(read_ranks(vocabulary))

    def sized() -> Callable[[pa.RecordBatch], list[int]]:
        encoder = Encoder(model)
        return lambda batch: [len(encoder.encode(t)) for t in batch.column(1).to_pylist()]

    return pack(df, key, sized, [text], capacity, open_bins)
