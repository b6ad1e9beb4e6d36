"""Areas of box unions against a raster; components of pictures against a flood fill, and their cost."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from framequarry.functions import images
from framequarry.functions.areas import component_boxes, components, runs, union_area

BOXES = "id int, h int, w int, boxes array<struct<x0:int,y0:int,x1:int,y1:int>>"


def flood(on, y, x):
    todo, seen = [(y, x)] if on[y, x] else [], set()
    while todo:
        y, x = todo.pop()
        if 0 <= y < on.shape[0] and 0 <= x < on.shape[1] and on[y, x] and (y, x) not in seen:
            seen.add((y, x))
            todo += [(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    return seen


def test_components_against_flood_fill():
    rng = np.random.default_rng(3)
    for h, w in ((1, 1), (1, 7), (7, 1), (6, 9), (9, 5)):
        for share in (0.2, 0.5, 0.8):
            pics = rng.random((40, h, w)) < share
            y, x = rng.integers(0, h, 40), rng.integers(0, w, 40)
            box, n = component_boxes(pics, y, x)
            for k in range(40):
                cells = flood(pics[k], y[k], x[k])
                assert n[k] == len(cells)
                if cells:
                    ys, xs = zip(*cells)
                    assert box[k].tolist() == [min(ys), min(xs), max(ys), max(xs)]


def test_pictures_of_a_batch_stay_apart_and_empty_ones_have_no_runs():
    full = np.ones((3, 4, 4), bool)
    line, first, last, label = components(full)
    assert len(set(label.tolist())) == 3 and len(line) == 12
    assert [len(a) for a in runs(np.zeros((2, 3, 3), bool))] == [0, 0, 0]
    assert component_boxes(np.zeros((2, 3, 3), bool), np.array([0, 1]), np.array([0, 1]))[1].tolist() == [0, 0]
    assert component_boxes(np.zeros((0, 3, 3), bool), np.zeros(0, int), np.zeros(0, int))[1].tolist() == []


def spiral(n):
    """One line of pixels, turning inwards, with a line of empty ones between its turns."""
    on, y, x, dy, dx = np.zeros((n, n), bool), 0, 0, 0, 1
    on[0, 0] = True
    while True:
        moved = 0
        while 0 <= y + dy < n and 0 <= x + dx < n and not on[y + dy, x + dx] and not (0 <= y + 2 * dy < n and 0 <= x + 2 * dx < n and on[y + 2 * dy, x + 2 * dx]):
            y, x, moved = y + dy, x + dx, moved + 1
            on[y, x] = True
        if moved < 2:
            return on
        dy, dx = dx, -dy


def test_a_spiral_takes_less_than_a_second_and_noise_grows_with_its_pixels():
    on = spiral(1000)
    began = time.process_time()
    box, n = component_boxes(on[None], np.array([0]), np.array([0]))
    took = time.process_time() - began
    assert n[0] == on.sum() > 400_000 and box[0].tolist() == [0, 0, 999, 999] and took < 1
    rng = np.random.default_rng(1)
    spent = []
    for side in (500, 1000):
        pic = rng.random((1, side, side)) < 0.5
        began = time.process_time()
        component_boxes(pic, np.array([0]), np.array([0]))
        spent.append(time.process_time() - began)
    assert spent[1] < 12 * spent[0]


def test_areas_against_a_raster(spark):
    r = random.Random(4)
    rows = []
    for i in range(150):
        h, w = r.randrange(1, 20), r.randrange(1, 20)
        boxes = []
        for _ in range(r.randrange(0, 7)):
            x, y = sorted((r.randrange(w), r.randrange(w))), sorted((r.randrange(h), r.randrange(h)))
            boxes.append((x[0], y[0], x[1], y[1]))
        rows.append((i, h, w, boxes))
    df = spark.createDataFrame(rows, BOXES).select("id", union_area(F.col("h"), F.col("w"), F.col("boxes")).alias("n"))
    want = {i: int((images.mask_of(h, w, [dict(zip(("x0", "y0", "x1", "y1"), b)) for b in bs]) > 0).sum()) for i, h, w, bs in rows}
    assert {r.id: r.n for r in df.collect()} == want
    assert "Python" not in df._jdf.queryExecution().toString()


def test_areas_of_odd_boxes(spark):
    rows = [(1, 5, 5, None), (2, 5, 5, []), (3, 5, 5, [(-3, -3, 1, 1)]), (4, 5, 5, [(3, 3, 99, 99)]), (5, 5, 5, [(4, 4, 1, 1)]), (6, 5, 5, [(9, 9, 12, 12)]), (7, 5, 5, [(0, 0, 4, 4)] * 3), (8, 0, 0, [(0, 0, 0, 0)])]
    df = spark.createDataFrame(rows, BOXES).select("id", union_area(F.col("h"), F.col("w"), F.col("boxes")).alias("n"))
    assert {r.id: r.n for r in df.collect()} == {1: 0, 2: 0, 3: 4, 4: 4, 5: 0, 6: 0, 7: 25, 8: 0}
