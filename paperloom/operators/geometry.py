"""Figure boxes: scale detection and pixel boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixel_box(bbox: Column, width: Column, height: Column) -> Column:
    """STRUCT<left, top, right, bottom INT> of [ymin, xmin, ymax, xmax] given
    as ratios (all in 0..1) or in thousandths; truncated toward zero. Null
    unless there are exactly four numbers, none of them null."""
    ratio = F.forall(bbox, lambda v: (v >= 0) & (v <= 1))
    scale = F.when(ratio, F.lit(1.0)).otherwise(F.lit(1000.0))
    at = lambda i, size: ((F.get(bbox, i) / scale) * size).try_cast("int")
    box = F.struct(at(1, width).alias("left"), at(0, height).alias("top"), at(3, width).alias("right"), at(2, height).alias("bottom"))
    return F.when((F.size(bbox) == 4) & ~F.exists(bbox, lambda v: v.isNull() | F.isnan(v)), box)


def figure_path(page: Column, q_index: Column, image: Column) -> Column:
    return F.format_string("assets/figures/page_%d_q_%d_img_%d.png", page, q_index, image)
