"""Runs a small NumPy function over image rows in Arrow batches: one row in, any number of rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

FLUSH_BYTES = 4 << 20
Kernel = Callable[[np.ndarray, dict], Iterable[tuple[tuple, np.ndarray]]]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes for this session: a Python worker holds several copies of its batch at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(FLUSH_BYTES))


def _cells(column: pa.Array) -> Sequence:
    """Python values; list columns as NumPy slices of the batch buffer."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        return column.to_pylist()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(int))
    valid = column.is_valid().to_pylist()
    return [flat[a:b] if ok else None for a, b, ok in zip(np.concatenate([[0], ends[:-1]]), ends, valid)]


class _Rows:
    """Collects output rows and turns them into record batches of bounded size."""

    def __init__(self, schema: pa.Schema, element: np.dtype):
        self.schema, self.element = schema, element
        self.clear()

    def clear(self) -> None:
        self.scalars, self.arrays, self.bytes = [], [], 0

    def add(self, scalars: tuple, img: np.ndarray) -> None:
        flat = np.ascontiguousarray(img, dtype=self.element).ravel()
        self.scalars.append((*scalars, *img.shape))
        self.arrays.append(flat)
        self.bytes += flat.nbytes

    def batch(self) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(a) for a in self.arrays])]).astype(np.int32)
        values = np.concatenate(self.arrays) if self.arrays else np.empty(0, self.element)
        names = self.schema.names
        columns = [pa.array([s[i] for s in self.scalars], type=self.schema.field(n).type) for i, n in enumerate(names[:-1])]
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(self.schema.field("data").type))
        self.clear()
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def expand_images(
    images: DataFrame, kernel: Kernel, keep: Sequence[str] = ("image_id",), params: Sequence[str] = (),
    extras: Sequence[tuple[str, T.DataType]] = (), shaped: bool = True,
) -> DataFrame:
    """Applies ``kernel(pixels, params) -> (extras, pixels)*`` to each row; output has keep, extras, h, w, c, data.

    With ``shaped=False`` the kernel gets the values as they are stored (or None) instead of an (h, w, c) array.

    Narrow: no shuffle, memory bounded by one Arrow batch plus one output batch.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches(images.sparkSession)
    element = images.schema["data"].dataType.elementType
    fields = [images.schema[k] for k in keep] + [T.StructField(n, t) for n, t in extras]
    fields += [T.StructField(n, T.IntegerType()) for n in ("h", "w", "c")] + [T.StructField("data", T.ArrayType(element))]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    dtype = np.dtype({"float": "f4", "double": "f8", "int": "i4", "bigint": "i8"}[element.simpleString()])
    wanted = list(dict.fromkeys([*keep, *params]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(arrow, dtype)
        for batch in batches:
            pixels = _cells(batch.column(batch.schema.get_field_index("data")))
            sizes = zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("h", "w", "c")])
            cells = {n: _cells(batch.column(batch.schema.get_field_index(n))) for n in wanted}
            for i, (flat, size) in enumerate(zip(pixels, sizes)):
                kept = tuple(cells[k][i] for k in keep)
                for extra, img in kernel(flat.reshape(size) if shaped else flat, {p: cells[p][i] for p in params}):
                    rows.add((*kept, *extra), img)
                if rows.bytes >= FLUSH_BYTES:
                    yield rows.batch()
            if rows.arrays:
                yield rows.batch()

    needed = list(dict.fromkeys([*wanted, "h", "w", "c", "data"]))
    return images.select(*needed).mapInArrow(run, schema)


def map_images(images: DataFrame, function: Callable[..., np.ndarray], keep: Sequence[str] = ("image_id",), params: Sequence[str] = ()) -> DataFrame:
    """One image to one image: ``function(pixels, **params)``."""
    return expand_images(images, lambda img, p: (((), function(img, **p)),), keep, params)


def spread(images: DataFrame, tasks: int) -> DataFrame:
    """At least ``tasks`` partitions for work that costs far more than reading, such as degradation.

    Stored images with enough splits pass unchanged; only a small input is shuffled.
    """
    return images if images.rdd.getNumPartitions() >= tasks else images.repartition(tasks, "image_id")


def to_pixels(images: DataFrame, *keep: str) -> DataFrame:
    """Pixel table ``(image_id, keep..., y, x, c, v)``."""
    at = images.select("image_id", *keep, F.col("w").alias("_w"), F.col("c").alias("_c"), F.posexplode("data").alias("_i", "v"))
    return at.selectExpr(
        "image_id", *keep, "cast(_i div (_w * _c) AS int) AS y", "cast(_i div _c % _w AS int) AS x", "cast(_i % _c AS int) AS c", "v"
    )
