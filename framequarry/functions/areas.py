"""Area of a union of boxes and connected components of pictures (X12, X14, A8), both without a walk over pixels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def union_area(h: Column, w: Column, boxes: Column) -> Column:
    """Pixels that the boxes (x0, y0, x1, y1, corners included) cover in a picture of ``h`` by ``w``, by the edges of the boxes.

    The left and right edges cut the picture into strips; in each strip the boxes that cross it are intervals, which are united
    in the order of their upper edges. The work follows the number of boxes, not the picture. Null boxes are none, and a
    box outside the picture or with corners the wrong way round covers nothing.
    """
    inside = F.transform(F.coalesce(boxes, F.array().cast("array<struct<x0:int,y0:int,x1:int,y1:int>>")), lambda b: F.struct(
        F.greatest(b["x0"], F.lit(0)).alias("a"), F.least(b["x1"] + 1, w).alias("b"), F.greatest(b["y0"], F.lit(0)).alias("top"), F.least(b["y1"] + 1, h).alias("end")))
    real = F.filter(inside, lambda b: (b["b"] > b["a"]) & (b["end"] > b["top"]))
    edges = F.array_sort(F.array_distinct(F.concat(F.transform(real, lambda b: b["a"]), F.transform(real, lambda b: b["b"]))))

    def height(left: Column) -> Column:
        here = F.array_sort(F.transform(F.filter(real, lambda b: (b["a"] <= left) & (b["b"] > left)), lambda b: F.struct(b["top"].alias("top"), b["end"].alias("end"))))
        start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
        add = lambda s, b: F.struct(F.greatest(s["upto"], b["end"]).alias("upto"), (s["n"] + F.greatest(F.lit(0), b["end"] - F.greatest(s["upto"], b["top"]))).alias("n"))
        return F.aggregate(here, start, add, lambda s: s["n"])

    strips = F.transform(edges, lambda x, i: (F.coalesce(F.get(edges, i + 1), x) - x) * height(x))
    return F.aggregate(strips, F.lit(0).cast("long"), lambda s, x: s + x)


def runs(pictures: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line (over all pictures, one after the other), first and last column of each run of set pixels, in this order."""
    n, h, w = pictures.shape
    edge = np.zeros((n * h, w + 1), np.int8)
    edge[:, :w] = pictures.reshape(n * h, w)
    edge[:, 1:] -= edge[:, :w].copy()
    line, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return line, first, stop - 1


def merge(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links (a, b) connect it with. In each round every root that has a smaller
    neighbour is put under it, so at most half of a component's roots stay."""
    up = np.arange(n)
    while True:
        x, y = up[a], up[b]
        far = x != y
        if not far.any():
            return up
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (top := up[up]).tobytes() != up.tobytes():
            up = top


def components(pictures: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``runs`` of a batch of pictures (n, h, w) and each run's component, neighbours at corners included.

    First pass: runs, and which of them touch a run of the line below, found by search over all pictures at once. Second pass:
    the runs' links merged into components. Linear in the pixels but for the search.
    """
    n, h, w = pictures.shape
    line, first, last = runs(pictures)
    wide = w + 2  # a run's neighbours in columns -1 to w of the next line are between the keys of the lines around it
    at_first, at_last = line * wide + first, line * wide + last
    below = np.flatnonzero(line % h < h - 1)
    # Runs of the next line that end at first - 1 or later and begin at last + 1 or earlier.
    lo = np.searchsorted(at_last, at_first[below] + wide - 1)
    hi = np.searchsorted(at_first, at_last[below] + wide + 1, side="right")
    count = np.maximum(hi - lo, 0)
    a = np.repeat(below, count)
    b = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
    return line, first, last, merge(len(line), a, b)


def component_boxes(pictures: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(top, left, bottom, right) and number of pixels of the component that holds pixel (y, x) of each picture; n is 0 where it isn't set."""
    n, h, w = pictures.shape
    line, first, last, label = components(pictures)
    box, size = np.zeros((n, 4), np.int64), np.zeros(n, np.int64)
    if not len(line):
        return box, size
    wide = w + 2
    want = (np.arange(n) * h + y) * wide + x
    at = np.minimum(np.searchsorted(line * wide + last, want), len(line) - 1)
    on = (line[at] == np.arange(n) * h + y) & (first[at] <= x) & (x <= last[at])
    row = line % h
    top, bottom, left, right, pixels = np.full(len(line), h), np.full(len(line), -1), np.full(len(line), w), np.full(len(line), -1), np.zeros(len(line), np.int64)
    np.minimum.at(top, label, row)
    np.maximum.at(bottom, label, row)
    np.minimum.at(left, label, first)
    np.maximum.at(right, label, last)
    np.add.at(pixels, label, last - first + 1)
    mine = label[at[on]]
    box[on] = np.stack([top[mine], left[mine], bottom[mine], right[mine]], axis=1)
    size[on] = pixels[mine]
    return box, size
