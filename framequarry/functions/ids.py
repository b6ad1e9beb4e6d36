"""Identity and path expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the form of an id.
ID = "[A-Za-z0-9_-]{11}"


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def id_from_url_loose(url: Column) -> Column:
    """What follows ``?v=``, ``&v=`` or ``youtu.be/``, up to a separator."""
    return _or_null(F.regexp_extract(url, r"(?:[?&]v=|youtu\.be/)([^&?#/\s]+)", 1))


def id_from_url_strict(url: Column) -> Column:
    """The same, only if it is an id of 11 characters."""
    return _or_null(F.regexp_extract(url, rf"(?:[?&]v=|youtu\.be/)({ID})(?![A-Za-z0-9_-])", 1))


def id_from_line(line: Column) -> Column:
    """A bare id, or the id in a watch, short, shorts or embed address."""
    bare = F.trim(line)
    found = F.regexp_extract(bare, rf"(?:v=|youtu\.be/|/shorts/|/embed/)({ID})", 1)
    return _or_null(F.when(bare.rlike(f"^{ID}$"), bare).otherwise(found))


def id_from_filename(name: Column) -> Column:
    return _or_null(F.regexp_extract(name, f"^({ID})", 1))


def id_or_stem(name: Column) -> Column:
    return F.coalesce(id_from_filename(name), stem(name))


def id_from_frame(name: Column) -> Column:
    """What is before the last ``_f``, else the stem."""
    return F.coalesce(_or_null(F.regexp_extract(name, "^(.*)_f", 1)), stem(name))


def id_from_video_file(name: Column) -> Column:
    """Before the first space, and of that before the first dot."""
    return F.split_part(F.split_part(name, F.lit(" "), F.lit(1)), F.lit("."), F.lit(1))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(basename(name), r"(?<=.)\.[^.]*$", "")


def image_id(video: Column, index: Column) -> Column:
    return F.format_string("%s_f%06d", video.cast("string"), index)


def image_filename(video: Column, index: Column) -> Column:
    return F.concat(image_id(video, index), F.lit(".jpg"))


def repoint(folder: str, name: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), basename(name))


#: The base address is a fixed value.
def default_url(url: Column, video: Column, base: str = "https://www.youtube.com/watch?v=") -> Column:
    return F.coalesce(_or_null(url), F.concat(F.lit(base), video))
