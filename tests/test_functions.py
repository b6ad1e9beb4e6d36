"""Expressions: ids, verdicts, replies, boxes, image maths."""

import json

import numpy as np
from pyspark.sql import functions as F

from framequarry.functions import boxes, ids, images, retry, text
from framequarry.functions.areas import component_boxes
from framequarry.plans.overlay import normalise


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("x")).first().x


def column(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ids(spark):
    k = "dQw4w9WgXcQ"
    lines = [k, f"https://a/watch?v={k}&t=1", f"https://youtu.be/{k}", f"x/shorts/{k}", f"x/embed/{k}", "short", None]
    assert column(spark, ids.id_from_line, lines) == [k] * 5 + [None, None]
    assert column(spark, ids.id_from_url_strict, [f"a?v={k}", f"a?v={k}Z"]) == [k, None]
    assert column(spark, ids.id_from_frame, ["ab_f_f000001.jpg", "plain.jpg"]) == ["ab_f", "plain"]
    assert column(spark, ids.stem, ["a/b.c.jpg", ".hidden"]) == ["b.c", ".hidden"]
    assert column(spark, ids.id_from_video_file, ["abc def.mp4", "abc.x.mp4"]) == ["abc", "abc"]
    assert one(spark, ids.image_filename(F.lit("v"), F.lit(7))) == "v_f000007.jpg"


def test_verdicts(spark):
    raw = ["YES.", "no", "None visible", "people", "", "maybe", "**No**", None, "NO people"]
    assert column(spark, text.verdict_yes_no, raw) == ["DROP", "KEEP", "KEEP", "DROP", "UNCLEAR", "UNCLEAR", "KEEP", "UNCLEAR", "DROP"]
    assert column(spark, text.verdict_keep_drop, ["KEEP or DROP", "farm", "", "crop", None]) == ["DROP", "KEEP", "DROP", "KEEP", "DROP"]


def test_error_class(spark):
    got = column(spark, text.error_class, ["Private video", "HTTP 429", "video unavailable 429", "odd"])
    assert got == ["permanent", "throttled", "permanent", "transient"]


def test_strip_and_cut(spark):
    assert column(spark, text.strip, ["\t a b\n "]) == ["a b"]
    assert column(spark, lambda c: text.cut(c, 3), ["  abcdef", "   ", None]) == ["abc", None, None]


def test_texty(spark):
    assert column(spark, lambda c: c.rlike(text.TEXTY), ["a Logo here", "logosphere", "In the Corner"]) == [True, False, True]


def test_backoff(spark):
    assert [one(spark, retry.backoff(F.lit(k))) for k in (0, 3, 9)] == [1, 8, 60]
    assert [one(spark, retry.due(F.lit(t).cast("double"), F.lit(30000.0))) for t in (None, 8400.0, 8399.0)] == [True, False, True]


def reply(**k):
    return json.dumps({"drop": False, "drop_reason": "none", "caption": "c", "boxes": []} | k)


def test_normalise(spark):
    good = {"label": "logo", "box": [10, 10, 20.5, 30]}
    raws = [
        "```json\n" + reply(boxes=[good, good, {"label": "logo", "box": [1, 2, 3]}, {"label": "logo", "box": [1, "x", 3, 4]}, {"label": "logo", "box": [5, 5, 5, 9]}]) + "\n```",
        "Sure: " + reply(drop="false", drop_reason="graphic") + " done",
        '{"drop": tru', None, reply(drop=0, caption="  ", boxes=[{"label": "logo", "box": [-5, 0, 2000, 10]}]),
    ]
    df = spark.createDataFrame([(i, r, None) for i, r in enumerate(raws)], "i int, raw_response string, error string")
    got = [r for r in normalise(df).orderBy("i").collect()]
    assert [(r.label, list(r.box)) for r in got[0].boxes] == [("logo", [10, 10, 20.5, 30])] and got[0].drop is False and got[0].drop_reason is None
    assert got[1].drop is True and got[1].drop_reason == "graphic"
    assert got[2].drop is None and got[2].boxes is None and got[3].drop is None
    assert got[4].drop is False and got[4].caption is None and list(got[4].boxes[0].box) == [0, 0, 1000, 10]


def test_dedupe_rounds_half_even(spark):
    df = spark.createDataFrame([([("a", [0.5, 0.0, 10.0, 10.0]), ("a", [0.4, 0.0, 10.0, 10.0]), ("b", [0.5, 0.0, 10.0, 10.0]), ("a", [1.5, 0.0, 10.0, 10.0])],)], "boxes array<struct<label:string,box:array<double>>>")
    assert [(b.label, b.box[0]) for b in df.select(boxes.dedupe(F.col("boxes")).alias("b")).first().b] == [("a", 0.5), ("b", 0.5), ("a", 1.5)]


def test_pixels_clip(spark):
    df = spark.createDataFrame([([("a", [0.0, 0.0, 1000.0, 1000.0]), ("b", [500.0, 500.0, 500.0, 500.0])],)], "boxes array<struct<label:string,box:array<double>>>")
    px = df.select(boxes.to_pixels(F.col("boxes"), F.lit(64), F.lit(36), 4).alias("p")).first().p
    assert [tuple(p) for p in px] == [(0, 0, 64, 36), (28, 14, 36, 22)]


def test_sharpness(spark):
    flat, spot = np.zeros((8, 8)), np.zeros((8, 8))
    spot[0, 0] = 1
    assert images.laplacian_variance(flat) == 0
    df = spark.createDataFrame([(spot.ravel().tolist(),), (np.arange(64.0).tolist(),)], "v array<double>")
    got = [r.x for r in df.select(images.grid_sharpness(F.col("v"), 8).alias("x")).collect()]
    want = [images.laplacian_variance(g) for g in (spot, np.arange(64.0).reshape(8, 8))]
    assert np.allclose(got, want)


def test_components_and_masks():
    on = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 0]], bool)
    box, n = component_boxes(np.stack([on, on]), np.array([0, 2]), np.array([0, 2]))
    assert n.tolist() == [2, 0] and box[0].tolist() == [0, 0, 1, 1]
    m = images.mask_of(4, 4, [{"x0": 1, "y0": 1, "x1": 2, "y1": 9}, {"x0": 2, "y0": 0, "x1": 2, "y1": 1}])
    assert (m > 0).sum() == 7


def test_refine_box_grows_to_band():
    img = np.zeros((100, 200, 3), np.uint8)
    img[70:90] = 200
    out = images.refine_box(img, [750, 100, 850, 700])
    assert out == [700.0, 0.0, 890.0, 995.0]
    assert images.refine_box(img, [750, 100, 850, 150]) == [750, 100, 850, 150]
