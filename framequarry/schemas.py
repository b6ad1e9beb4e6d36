"""Explicit schemas of the tables that stages exchange."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


BOX = _of(("label", _S), ("box", T.ArrayType(_D)))
BOXES = T.ArrayType(BOX)
PLAYLIST = _of(("id", _S), ("duration_seconds", _I), ("title", _S), ("url", _S))
CANDIDATES = _of(("video_id", _S), ("cand_idx", _I), ("t", _D), ("score", _D))
FRAMES = _of(("image_id", _S), ("image_filename", _S), ("relative_path", _S), ("video_id", _S), ("video_title", _S), ("timestamp_seconds", _D), ("frame_index", _I), ("fps_sampled", _D), ("video_url", _S))
PEOPLE_SCAN = _of(("image_filename", _S), ("video_id", _S), ("person_count", _I), ("max_person_conf", _D), ("kept", _I))
PEOPLE_FILTERED = T.StructType([*FRAMES.fields, T.StructField("filter_status", _S), T.StructField("raw_response", _S)])
DETECTIONS = _of(
    ("image_id", _S), ("image_filename", _S), ("relative_path", _S), ("video_id", _S), ("video_title", _S), ("video_url", _S), ("timestamp_seconds", _D), ("model", _S),
    ("drop", _B), ("drop_reason", _S), ("caption", _S), ("boxes", BOXES), ("usage", T.MapType(_S, _L)), ("error", _S), ("raw_response", _S), ("ts", _S),
)
DETECTIONS_REFINED = T.StructType([*DETECTIONS.fields, T.StructField("boxes_original", BOXES)])
DESCRIPTIONS = _of(("image_id", _S), ("image_filename", _S), ("descriptive_text", _S), ("prompt_text", _S), ("model", _S), ("usage", T.MapType(_S, _L)), ("error", _S), ("raw_response", _S), ("ts", _S))
FLAGS = _of(("caption", _S), ("flag", _I))
CLEANS = _of(("caption", _S), ("clean", _S))
DESCRIPTION_FLAGS = _of(("description", _S), ("flag", _I))
DESCRIPTION_CLEANS = _of(("description", _S), ("clean", _S))
FINAL = _of(
    ("image_id", _S), ("image_filename", _S), ("relative_path", _S), ("video_id", _S), ("video_title", _S), ("video_url", _S), ("timestamp_seconds", _D),
    ("caption", _S), ("had_overlay", _B), ("overlay_inpainted", _B), ("n_boxes", _I),
)
FINAL_DESCRIBED = T.StructType([*FINAL.fields[:8], T.StructField("descriptive_text", _S), *FINAL.fields[8:]])
SHARD = T.StructType([T.StructField("image", _of(("bytes", T.BinaryType()), ("path", _S))), *(f for f in FINAL_DESCRIBED.fields if f.name != "relative_path")])
ATTEMPTS = _of(("id", _S), ("ts", _D))
TRANSFER = _of(("name", _S), ("local_size", _L), ("remote_size", _L))
STATUS = _of(("video_id", _S), ("status", _S))
LABEL_REPLY = "labels array<struct<i:int,v:string>>"
REWRITE_REPLY = "items array<struct<i:int,caption:string,description:string>>"
