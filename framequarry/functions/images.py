"""Image maths on raw bytes as batched Arrow functions (X1, X12, X14, A6-A8, M12) and on small arrays in SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.functions.areas import component_boxes, union_area
from framequarry.schemas import BOXES


def laplacian_variance(grid: np.ndarray) -> float:
    """Population variance of the four-neighbour Laplacian; the edge pixel is repeated outside."""
    g = np.pad(grid.astype(float), 1, mode="edge")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var()) if grid.size else 0.0


def sharpness_of(rgb: bytes, h: int, w: int, step: int = 4) -> float:
    return laplacian_variance(np.frombuffer(rgb, np.uint8).reshape(h, w, 3)[::step, ::step, 1].astype(np.int16))


@F.pandas_udf(T.DoubleType())
def sharpness(rgb: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
    return pd.Series([sharpness_of(b, int(y), int(x)) if b is not None else None for b, y, x in zip(rgb, h, w)])


def grid_sharpness(values: Column, side: int) -> Column:
    """The same in SQL for a small square grid given as a flat array."""
    at = lambda i, dy, dx: F.element_at(values, (F.least(F.greatest(F.floor(i / side) + dy, F.lit(0)), F.lit(side - 1)) * side + F.least(F.greatest(i % side + dx, F.lit(0)), F.lit(side - 1)) + 1).cast("int")).cast("double")
    lap = F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: at(i, -1, 0) + at(i, 1, 0) + at(i, 0, -1) + at(i, 0, 1) - 4 * at(i, 0, 0))
    n = float(side * side)
    add = lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + x * x).alias("q"))
    # Sum and sum of squares in one pass, so that the Laplacian is made once for each row.
    return F.aggregate(lap, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")), add, lambda a: a["q"] / n - (a["s"] / n) * (a["s"] / n))


def mask_of(h: int, w: int, boxes) -> np.ndarray:
    """0/255 mask of the union of pixel boxes (x0, y0, x1, y1), corners included."""
    m = np.zeros((h, w), np.uint8)
    for b in boxes if boxes is not None else []:
        x0, y0, x1, y1 = (int(b[k]) for k in ("x0", "y0", "x1", "y1"))
        m[y0 : y1 + 1, x0 : x1 + 1] = 255
    return m


@F.pandas_udf(T.BinaryType())
def mask(h: pd.Series, w: pd.Series, boxes: pd.Series) -> pd.Series:
    return pd.Series([mask_of(int(y), int(x), b).tobytes() for y, x, b in zip(h, w, boxes)])


def mask_area(h: Column, w: Column, boxes: Column) -> Column:
    """Pixels of the mask, by the boxes' edges and without a raster."""
    return union_area(h, w, boxes)


def background(ring: np.ndarray, step: int = 16) -> np.ndarray:
    """Middle of the most frequent quantised colour; of equals the smallest."""
    q, n = np.unique(ring // step, axis=0, return_counts=True)
    return q[n.argmax()].astype(float) * step + step / 2


#: The defaults are fixed values: colour distance, least width and most area of a grown box, and the rim that is looked at.
def refine_box(img: np.ndarray, box: list[float], tol: float = 38, wide: float = 0.2, most: float = 0.6, rim: int = 6) -> list[float]:
    """A wide box grown to the flat band around it: the component, at the box's centre, of what has the colour of its rim."""
    h, w = img.shape[:2]
    y0, y1 = (min(h, max(0, int(v / 1000 * h))) for v in (box[0], box[2]))
    x0, x1 = (min(w, max(0, int(v / 1000 * w))) for v in (box[1], box[3]))
    if y1 <= y0 or x1 <= x0 or x1 - x0 < wide * w:
        return box
    around = np.zeros((h, w), bool)
    around[max(0, y0 - rim) : y1 + rim, max(0, x0 - rim) : x1 + rim] = True
    around[y0:y1, x0:x1] = False
    if not around.any():
        return box
    near = np.sqrt(((img.astype(float) - background(img[around])) ** 2).sum(2)) < tol
    cy, cx = (y0 + y1) // 2, (x0 + x1) // 2
    if not near[min(cy, h - 1), min(cx, w - 1)]:
        inside = np.argwhere(near[y0:y1, x0:x1])
        if not len(inside):
            return box
        cy, cx = y0 + inside[0][0], x0 + inside[0][1]
    top, left, bottom, right = component_boxes(near[None], np.array([cy]), np.array([cx]))[0][0]
    if right - left >= 0.5 * w:
        left, right = 0, w - 1
    if (right - left) * (bottom - top) > most * w * h:
        return box
    return [float(v) for v in (top / h * 1000, left / w * 1000, bottom / h * 1000, right / w * 1000)]


@F.pandas_udf(BOXES)
def refine_boxes(rgb: pd.Series, h: pd.Series, w: pd.Series, boxes: pd.Series) -> pd.Series:
    """Graphic overlays refined, other boxes as they are."""
    out = []
    for b, y, x, bs in zip(rgb, h, w, boxes):
        img = np.frombuffer(b, np.uint8).reshape(int(y), int(x), 3) if b is not None else None
        out.append([{"label": k["label"], "box": refine_box(img, list(k["box"])) if img is not None and k["label"] == "graphic_overlay" else list(k["box"])} for k in (bs if bs is not None else [])])
    return pd.Series(out)


@F.pandas_udf(T.BinaryType())
def inpaint_mean(rgb: pd.Series, m: pd.Series) -> pd.Series:
    """Stand-in for an inpainting model: masked pixels take the mean colour of the others."""
    out = []
    for b, k in zip(rgb, m):
        px, on = np.frombuffer(b, np.uint8).reshape(-1, 3).copy(), np.frombuffer(k, np.uint8) > 0
        if on.any():
            px[on] = px[~on].mean(0).astype(np.uint8) if (~on).any() else 0
        out.append(px.tobytes())
    return pd.Series(out)
