"""Box expressions on arrays of (label, [ymin, xmin, ymax, xmax]) in thousandths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_boxes(v: Column) -> Column:
    """Boxes of a reply (VARIANT); an element that is not a number spoils its own box only."""
    raw = F.try_variant_get(v, "$.boxes", "array<variant>")
    # Elements are read one by one as text, so that a typed array can't turn null as a whole.
    return F.transform(raw, lambda b: F.struct(F.try_variant_get(b, "$.label", "string").alias("label"), F.transform(F.try_variant_get(b, "$.box", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string").try_cast("double")).alias("box")))


def clamp(boxes: Column) -> Column:
    """Valid boxes only: four numbers, cut to 0-1000, with an area."""
    four = F.filter(boxes, lambda b: F.coalesce((F.size(b["box"]) == 4) & ~F.exists(b["box"], lambda x: x.isNull() | F.isnan(x)), F.lit(False)))
    cut = F.transform(four, lambda b: F.struct(b["label"].alias("label"), F.transform(b["box"], lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1000.0), x))).alias("box")))
    return F.filter(cut, lambda b: (b["box"][2] > b["box"][0]) & (b["box"][3] > b["box"][1]))


def dedupe(boxes: Column) -> Column:
    """First of the boxes with equal label and coordinates rounded half to even."""
    key = lambda b: F.struct(F.coalesce(b["label"], F.lit("")).alias("l"), b["label"].isNull().alias("n"), F.transform(b["box"], lambda x: F.bround(x, 0)).alias("k"))
    keys = F.transform(boxes, key)
    return F.filter(boxes, lambda b, i: F.array_position(keys, key(b)) == i + 1)


def to_pixels(boxes: Column, w: Column, h: Column, pad: int = 0) -> Column:
    """x0, y0, x1, y1 with padding, cut to the frame; truncated towards zero; boxes without area go."""
    low = lambda v, side: F.greatest(F.lit(0), (v / 1000 * side).cast("int") - pad)
    high = lambda v, side: F.least(side, (v / 1000 * side).cast("int") + pad)
    px = F.transform(boxes, lambda b: F.struct(low(b["box"][1], w).alias("x0"), low(b["box"][0], h).alias("y0"), high(b["box"][3], w).alias("x1"), high(b["box"][2], h).alias("y1")))
    return F.filter(px, lambda p: (p["x1"] > p["x0"]) & (p["y1"] > p["y0"]))


def count(boxes: Column) -> Column:
    return F.coalesce(F.size(boxes), F.lit(0)) if boxes is not None else F.lit(0)


def wide(box: Column, share: float = 0.2) -> Column:
    """At least ``share`` of the frame's width."""
    return (box[3] - box[1]) / 1000 >= share
