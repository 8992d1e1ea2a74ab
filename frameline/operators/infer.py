"""Batch inference around any Python model, request handling, results and content compression."""

from __future__ import annotations

import gzip
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameline import schemas
from frameline.functions import sizing
from frameline.operators.image_rows import FLUSH_BYTES, _cells, _Rows, small_batches

# Model variants with the scale of their output; the default takes the place of unknown ones.
VARIANT_SCALE = {"real_sr": 4, "classical_sr": 4, "lightweight_sr": 4, "color_dn": 1, "jpeg_car": 1}
DEFAULT_VARIANT = "real_sr"
DEFAULT_BATCH_JOB = "batch_job"


def route_model(requests: DataFrame, anime_family: str = "family_a", photo_family: str = "family_b") -> DataFrame:
    """Model kind per request (face before anime before standard) and the family that serves it."""
    face = F.coalesce(F.lower("face_enhanced") == "yes", F.lit(False))
    anime = F.coalesce(F.lower("is_anime").isin("yes", "true"), F.lit(False))
    kind = F.when(face, "face").when(anime, "anime").otherwise("standard")
    return requests.withColumn("model", kind).withColumn("family", F.when(anime, anime_family).otherwise(photo_family))


def resolve_variant(requests: DataFrame, available: Sequence[str] | None = None, variants: dict[str, int] | None = None) -> DataFrame:
    """Variant to use and its scale; an unknown, absent or uninstalled variant becomes the default."""
    variants = VARIANT_SCALE if variants is None else variants
    usable = [v for v in variants if available is None or v in available]
    used = F.when(F.col("model_variant").isin(*usable), F.col("model_variant")).otherwise(DEFAULT_VARIANT) if usable else F.lit(DEFAULT_VARIANT)
    scales = F.create_map(*[F.lit(x) for v, s in variants.items() for x in (v, s)])
    return requests.withColumn("variant", used).withColumn("scale", F.element_at(scales, F.col("variant")))


def explode_requests(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per image from a JSON body that is one request, a list, or ``{"batch": [...], "job_id": ...}``.

    In the batch form the position is the batch id. A body that cannot be read gives one row with an error.
    """
    single = T.StructType([*schemas.REQUEST.fields, T.StructField("batch", T.ArrayType(schemas.REQUEST))])
    is_list = F.ltrim(F.col(body)).startswith("[")
    as_list = F.from_json(F.col(body), T.ArrayType(schemas.REQUEST))
    one = F.from_json(F.col(body), single)
    alone = F.array(F.struct(*[one[n].alias(n) for n in schemas.REQUEST.names]))
    items = F.when(is_list, as_list).when(one["batch"].isNotNull(), one["batch"]).otherwise(alone)
    in_batch = ~is_list & one["batch"].isNotNull()
    rest = [c for c in bodies.columns if c != body]
    rows = bodies.select(*rest, in_batch.alias("_in_batch"), one["job_id"].alias("_job"), F.posexplode_outer(items).alias("_pos", "_item"))
    fields = {n: F.col(f"_item.{n}") for n in schemas.REQUEST.names}
    fields["job_id"] = F.when(F.col("_in_batch"), F.coalesce("_job", F.lit(DEFAULT_BATCH_JOB))).otherwise(fields["job_id"])
    fields["batch_id"] = F.when(F.col("_in_batch"), F.col("_pos").cast("string")).otherwise(fields["batch_id"])
    missing = F.col("_item").isNull() | fields["input_file_path"].isNull()
    return rows.select(*rest, *[v.alias(n) for n, v in fields.items()], F.when(missing, "unreadable request").alias("error"))


class ModelRegistry:
    """Loads models by key and keeps the ``max_models`` used last; lives once per Python worker process.

    A registry is made on the driver and travels to the workers with its own token, so that two loaders never share a
    model, whatever they are called.
    """

    _cached: OrderedDict = OrderedDict()

    def __init__(self, loader: Callable[[str], object], max_models: int = 5):
        self.loader, self.max_models, self.token = loader, max_models, uuid.uuid4().hex

    def get(self, key: str) -> object:
        cache, slot = ModelRegistry._cached, (self.token, key)
        if slot not in cache:
            cache[slot] = self.loader(key)
        cache.move_to_end(slot)
        while len(cache) > self.max_models:
            cache.popitem(last=False)
        return cache[slot]


def infer(
    requests: DataFrame, loader: Callable[[str], object], predict: Callable[[object, np.ndarray, dict], np.ndarray],
    batch: int = 16, max_models: int = 5, params: Sequence[str] = (), tasks: int | None = None,
) -> DataFrame:
    """Runs a model on every request row; one result row per request, and a failing row never fails the rest.

    Rows carry ``job_id, batch_id, output_file_path, model_key`` and an image (``data`` null: unreadable).
    ``tasks`` spreads the work evenly by request instead of by stored bytes. Results are given out after ``batch`` rows
    or ``FLUSH_BYTES``, whichever comes first.
    """
    element = requests.schema["data"].dataType.elementType
    dtype = np.dtype({"tinyint": "i1", "smallint": "i2", "int": "i4", "bigint": "i8", "float": "f4", "double": "f8"}[element.simpleString()])
    keys = ("job_id", "batch_id")
    out = T.StructType([requests.schema[k] for k in keys] + [
        T.StructField("status", T.IntegerType()), T.StructField("output_file_path", T.StringType()), T.StructField("error", T.StringType()),
        *[T.StructField(n, T.IntegerType()) for n in ("h", "w", "c")], T.StructField("data", T.ArrayType(element)),
    ])
    names = list(dict.fromkeys([*keys, "output_file_path", "model_key", "h", "w", "c", *params]))
    registry = ModelRegistry(loader, max_models)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(arrow, dtype)
        for record in batches:
            cells = {n: _cells(record.column(record.schema.get_field_index(n))) for n in names}
            pixels = _cells(record.column(record.schema.get_field_index("data")))
            for i, flat in enumerate(pixels):
                row = {n: cells[n][i] for n in names}
                try:
                    if flat is None:
                        raise ValueError("Failed to read image")
                    img = flat.reshape(row["h"], row["w"], row["c"])
                    result = predict(registry.get(row["model_key"]), img, row)
                    rows.add((row["job_id"], row["batch_id"], 200, row["output_file_path"], None), result)
                except Exception as error:  # noqa: BLE001 - the row reports it
                    rows.add((row["job_id"], row["batch_id"], 500, None, str(error)), np.empty((0, 0, 0)))
                if len(rows.arrays) >= batch or rows.bytes >= FLUSH_BYTES:
                    yield rows.batch()
        if rows.arrays:
            yield rows.batch()

    work = requests.select(*names, "data")
    if tasks is not None:
        work = work.repartition(tasks, *keys)
    return work.mapInArrow(run, out)


def nearest_loader(key: str) -> int:
    """Stand-in model: the enlargement factor of the variant."""
    return VARIANT_SCALE[key]


def nearest_predict(model: int, img: np.ndarray, row: dict) -> np.ndarray:
    from frameline.functions.pixels import upsample_nearest

    return upsample_nearest(img, model)


def batch_rollup(results: DataFrame) -> DataFrame:
    """Per job: overall status, requests processed, and how many of them failed."""
    return results.groupBy("job_id").agg(
        F.lit(200).alias("status"), F.count(F.lit(1)).alias("total_processed"), F.count_if(F.col("status") != 200).alias("failed")
    )


def nested_results(results: DataFrame, size: int = sizing.LARGEST_BATCH) -> DataFrame:
    """Results as lists of at most ``size``, ordered by batch id, one list per sub-batch of a job.

    A batch id that is no number has no sub-batch (null) and a list of its own; results without any id are told apart by
    where they were written.
    """
    held = F.struct("batch_id", "status", "output_file_path", "error")
    number = F.col("batch_id").try_cast("long")
    other = F.when(number.isNull(), F.struct(F.col("batch_id").cast("string").alias("id"), F.when(F.col("batch_id").isNull(), F.col("output_file_path")).alias("path")))
    grouped = results.groupBy("job_id", sizing.int_div(number, size).alias("sub_batch"), other.alias("_other"))
    return grouped.agg(F.sort_array(F.collect_list(held)).alias("batch_results")).drop("_other")


def ordered_results(results: DataFrame) -> DataFrame:
    """By job, then by the number of the batch; ids that are no numbers come last, by their text."""
    return results.orderBy("job_id", F.col("batch_id").try_cast("long").asc_nulls_last(), "batch_id")


def _map_content(df: DataFrame, keep: Sequence[str], change: Callable[[str | None, bytes], bytes]) -> DataFrame:
    """``change(key, content)`` of each row, given out in batches of bounded bytes."""
    schema = T.StructType([*[df.schema[k] for k in keep], T.StructField("key", T.StringType()), T.StructField("content", T.BinaryType()),
                           T.StructField("size", T.LongType()), T.StructField("new_size", T.LongType())])
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(k)) for k in (*keep, "key")]
            contents, start, after, held = batch.column(batch.schema.get_field_index("content")), 0, [], 0
            sizes = pc.binary_length(contents).cast(pa.int64())
            for i, key in enumerate(kept[-1]):
                content = contents[i].as_py()
                after.append(None if content is None else change(key.as_py(), content))
                held += len(after[-1] or b"")
                if held >= FLUSH_BYTES or i + 1 == batch.num_rows:
                    n = len(after)
                    news = pa.array([None if b is None else len(b) for b in after], pa.int64())
                    columns = [*[c.slice(start, n) for c in kept], pa.array(after, pa.binary()), sizes.slice(start, n), news]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, "key", "content", "size", "new_size"])
                    start, after, held = i + 1, [], 0

    return df.select(*keep, "key", "content").mapInArrow(run, schema)


def gzip_content(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Compressed twin ``key.gz`` of each content with both sizes; the same input always gives the same bytes."""
    packed = _map_content(df, keep, lambda _, b: gzip.compress(b, mtime=0))
    return packed.withColumn("key", F.concat("key", F.lit(".gz")))


def gunzip_content(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Plain content of ``.gz`` keys, other keys unchanged, in one pass; rows without a key are left out."""
    plain = _map_content(df.filter(F.col("key").isNotNull()), keep, lambda key, b: gzip.decompress(b) if key.endswith(".gz") else b)
    return plain.withColumn("key", F.regexp_replace("key", r"\.gz$", ""))


def checksum(column: Column) -> Column:
    """Checksum of pixel values, for comparing results without moving them."""
    return F.aggregate(column, F.lit(0.0), lambda a, v: a + v)
