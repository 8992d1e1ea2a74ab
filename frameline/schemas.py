"""Fixed schemas of the tables and messages."""

from __future__ import annotations

from pyspark.sql import types as T

JOB = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("video_name", T.StringType()),
    T.StructField("source_bucket", T.StringType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("frames", T.StructType([
        T.StructField("total", T.LongType()),
        T.StructField("extracted", T.LongType()),
        T.StructField("processed", T.LongType()),
    ])),
])

OBJECT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.TimestampNTZType()),
])

TAGS = T.ArrayType(T.StructType([
    T.StructField("Key", T.StringType()),
    T.StructField("Value", T.StringType()),
]))

IMAGE = T.StructType([
    T.StructField("image_id", T.LongType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("c", T.IntegerType()),
    T.StructField("data", T.ArrayType(T.DoubleType(), False)),
])

_OBJECT_REF = T.StructType([
    T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
])

UPLOAD_EVENT = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([T.StructField("s3", _OBJECT_REF)]))),
])

REQUEST = T.StructType([
    T.StructField("input_file_path", T.StringType()),
    T.StructField("output_file_path", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("is_anime", T.StringType()),
    T.StructField("face_enhanced", T.StringType()),
    T.StructField("model_variant", T.StringType()),
    T.StructField("tile_size", T.IntegerType()),
])
