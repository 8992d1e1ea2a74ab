"""Column functions over object keys, URIs and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Video suffixes accepted for processing.
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv")

# File-based pipeline status -> job status.
STATUS_NAMES = {
    "pending": "INITIATED",
    "extracting": "EXTRACTING",
    "upscaling": "PROCESSING",
    "processing": "PROCESSING",
    "encoding": "RECOMPOSING",
    "uploaded": "COMPLETED",
    "error": "FAILED",
}

_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def is_video(key: Column) -> Column:
    alternatives = "|".join(s.lstrip(".") for s in VIDEO_SUFFIXES)
    return F.lower(key).rlike(rf"\.({alternatives})$")


def base_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def stem(key: Column) -> Column:
    """Base name up to the last dot; a name whose only dots lead it has no extension."""
    return F.regexp_replace(base_name(key), r"^(\.*[^.].*)\.[^.]*$", "$1")


def extension(key: Column) -> Column:
    """Text after the last dot, empty when there is none."""
    return F.regexp_extract(base_name(key), r"^\.*[^.].*\.([^.]*)$", 1)


def split_name(key: Column) -> Column:
    return F.struct(base_name(key).alias("base"), stem(key).alias("stem"), extension(key).alias("ext"))


def split_uri(uri: Column) -> Column:
    """Bucket and key of an ``s3://`` URI; anything else is a local path with a null bucket."""
    remote = uri.startswith("s3://")
    return F.struct(
        F.when(remote, F.regexp_extract(uri, r"^s3://([^/]*)", 1)).alias("bucket"),
        F.when(remote, F.regexp_extract(uri, r"^s3://[^/]*/?(.*)$", 1)).otherwise(uri).alias("key"),
    )


def key_part(key: Column, index: int) -> Column:
    """The ``index``-th slash-separated part, counted from 0; null beyond the last part."""
    return F.get(F.split(key, "/"), F.lit(index))


def media_type(key: Column) -> Column:
    """Third path part from the end; null for shorter paths."""
    parts = F.split(key, "/")
    return F.when(F.size(parts) >= 3, F.get(parts, F.size(parts) - 3))


def is_anime_key(key: Column) -> Column:
    return F.coalesce(media_type(key) == "anime", F.lit(False))


def task_uuid(path: Column) -> Column:
    found = F.regexp_extract(path, f"/[^/]*/({_UUID})/", 1)
    return F.when(found != "", found)


def frame_key(base: Column, n: Column, total: Column, ext: Column) -> Column:
    """``base_NNN.ext`` with ``n`` zero-padded to the digits of ``total``; a longer ``n`` keeps all its digits."""
    digits = n.cast("string")
    return F.concat(base, F.lit("_"), F.lpad(digits, F.greatest(F.length(digits), F.length(total.cast("string"))), F.lit("0")), F.lit("."), ext)


def normalize_status(status: Column) -> Column:
    """Maps the file-based vocabulary onto the job vocabulary; job statuses stay as they are."""
    out = None
    for name, job_status in STATUS_NAMES.items():
        out = F.when(status == name, job_status) if out is None else out.when(status == name, job_status)
    return out.otherwise(F.upper(status))
