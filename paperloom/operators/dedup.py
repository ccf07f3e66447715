"""First-wins removal of repeats inside a document, and its failure rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import release, stage


def first_wins(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The row of smallest ``order`` in each group. Combined before the
    shuffle, so that a hot group costs no more than any other. Null group
    values form a group; ``order`` is expected to be unique in a group."""
    rest = [c for c in df.columns if c not in group]
    # min_by keeps one row's value; each column follows the same row.
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*group).agg(best).select(*group, *[F.col(f"_row.{c}").alias(c) for c in rest])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends of pages of rows sorted by (g, p, i), one row after the other. The
    state is one document's texts of the rows given, carried over batches."""
    at, seen, dead = None, set(), None
    for b in batches:
        keep, before = [], at
        for k, (g, p, f, t) in enumerate(zip(*[b.column(c).to_pylist() for c in ("g", "p", "f", "t")])):
            if k == 0 and at is None or g != before:
                at = before = g
                seen, dead = set(), None
            if dead == (p,):
                continue
            if f == "before":
                keep.append(k)
                dead = (p,)
            elif t not in seen:
                seen.add(t)
                if f == "after":
                    keep.append(k)
                    dead = (p,)
        yield b.select(["g", "p", "i"]).take(pa.array(keep, pa.int64()))


def survivors(df: DataFrame, document: str, page: str, index: str, text: str, failure: str, rounds: int = 6) -> DataFrame:
    """Rows kept when a failing row ends its page.

    ``failure``: null for none, 'before' or 'after' the row's text counts as
    seen. A failing row and the rest of its page are lost; one that fails
    'after' still uses up its text, if no reached row had it before. Rows are
    ordered by (page, index), which is unique in a document; rows without a
    document or page are dropped.

    Whether an 'after' row fails depends only on rows before it, so the set of
    rows that end their pages is a unique fixpoint. ``rounds`` passes over the
    rows that share a text with such a row settle all but long chains of
    pages that depend on each other; the documents that still change, a chain
    being a sequence, are folded in order over those rows, as a stream.
    """
    df = df.dropna(subset=[document, page])
    at = F.struct(F.col(page).alias("p"), F.col(index).alias("i"))
    rows = df.select(F.col(document).alias("g"), F.col(page).alias("p"), F.col(index).alias("i"), F.col(failure).alias("f"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("t"), at.alias("at"))
    before = rows.filter("f = 'before'").select("g", "p", "i")
    after = rows.filter("f = 'after'").select("g", "t").distinct()
    linked = stage(rows.filter("f IS NULL OR f = 'after'").join(after, ["g", "t"], "left_semi"), "fold")
    kills = before.unionByName(linked.filter("f = 'after'").select("g", "p", "i"))
    ends = stage(kills.groupBy("g", "p").agg(F.min("i").alias("end")), "fold-ends")
    changed = None
    for _ in range(rounds):
        reached = linked.join(ends, ["g", "p"], "left").filter("end IS NULL OR i <= end")
        first = reached.groupBy("g", "t").agg(F.min_by(F.struct("p", "i", "f"), "at").alias("m"))
        now = before.unionByName(first.filter("m.f = 'after'").select("g", F.col("m.p").alias("p"), F.col("m.i").alias("i")))
        new = stage(now.groupBy("g", "p").agg(F.min("i").alias("end")), "fold-ends")
        changed = stage(new.join(ends, ["g", "p", "end"], "left_anti").unionByName(ends.join(new, ["g", "p", "end"], "left_anti")).select("g").distinct(), "fold-open")
        release(ends)
        ends = new
        if changed.isEmpty():
            changed = None
            break
    if changed is not None:
        open_ = linked.select("g", "p", "i", "f", "t").unionByName(rows.filter("f = 'before'").select("g", "p", "i", "f", "t")).join(changed, "g", "left_semi")
        schema = open_.select("g", "p", "i").schema
        folded = open_.repartition("g").sortWithinPartitions("g", "p", "i").mapInArrow(_fold, schema).withColumnRenamed("i", "end")
        ends = stage(ends.join(changed, "g", "left_anti").unionByName(folded), "fold-ends")
    bounds = ends.select(F.col("g").alias(document), F.col("p").alias(page), "end")
    alive = df.join(bounds, [document, page], "left").filter(F.col("end").isNull() | (F.col(index) < F.col("end")) | ((F.col(index) == F.col("end")) & (F.col(failure) == "after")))
    kept = first_wins(alive.drop("end"), [document, text], [page, index])
    return kept.filter(F.col(failure).isNull()).select(*df.columns)
