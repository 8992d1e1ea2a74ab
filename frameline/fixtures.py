"""Pipeline tables derived from the star-schema test tables.

Each derivation is one projection whose text runs unchanged on Spark SQL and on the check engine, so a
check query can start from the same rows. On the Spark side it is a plain ``selectExpr`` and therefore
also works on a stream of the source table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB_NOW = "2000-01-01 00:00:00"
EVENT_NOW = "2024-01-31 00:00:00"

_UUID = " || '-' || ".join(
    f"substr(md5(cast(o_orderkey AS string)),{start},{size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
)


@dataclass(frozen=True)
class Derivation:
    table: str
    columns: tuple[str, ...]
    where: str | None = None
    distinct: bool = False
    group: str | None = None

    def text(self) -> str:
        sql = f"SELECT {'DISTINCT ' if self.distinct else ''}{', '.join(self.columns)} FROM {self.table}"
        if self.where:
            sql += f" WHERE {self.where}"
        if self.group:
            sql = f"SELECT {self.group}, max(size) AS size, max(last_modified) AS last_modified FROM ({sql}) t GROUP BY {self.group}"
        return sql

    def apply(self, source: DataFrame) -> DataFrame:
        rows = source if self.where is None else source.filter(self.where)
        rows = rows.selectExpr(*self.columns)
        if self.distinct:
            rows = rows.distinct()
        if self.group:
            rows = rows.groupBy(self.group).agg(F.max("size").alias("size"), F.max("last_modified").alias("last_modified"))
        return rows


DERIVED = {
    "jobs": Derivation("orders", (
        "'job-' || cast(o_orderkey AS string) AS job_id",
        "'video_' || cast(o_orderkey AS string) || CASE o_orderkey % 5 WHEN 0 THEN '.mp4' WHEN 1 THEN '.AVI' WHEN 2 THEN '.mov' WHEN 3 THEN '.mkv' ELSE '.pdf' END AS video_name",
        f"'data/src/' || CASE WHEN o_orderkey % 2 = 0 THEN 'real' ELSE 'anime' END || '/' || {_UUID} || '/video_' || cast(o_orderkey AS string) || '.mp4' AS source_key",
        "cast(floor(o_totalprice) AS bigint) AS content_length",
        "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'PROCESSING' WHEN o_orderpriority = '1-URGENT' THEN 'FAILED' ELSE 'INITIATED' END AS status",
        "o_orderdate AS updated_at",
        "'ep-' || cast(o_custkey % 50 AS string) || ',ep-' || cast(o_custkey % 7 AS string) AS endpoints",
    ), where="o_orderkey % 10 <> 0"),
    "objects": Derivation("lineitem", (
        "'job-' || cast(l_orderkey AS string) || CASE WHEN l_linestatus = 'F' THEN '/frames/frame_' ELSE '/temp/frame_' END || lpad(cast(l_linenumber AS string), 4, '0') || CASE WHEN l_returnflag = 'A' THEN '.png.gz' ELSE '.png' END AS key",
        "cast(floor(l_quantity * 1024) AS bigint) AS size",
        "l_shipdate AS last_modified",
    ), group="key"),
    "probes": Derivation("orders", (
        "'job-' || cast(o_orderkey AS string) AS job_id",
        "cast(1 + o_orderkey % 1500 AS bigint) AS frames_total",
        "CASE o_orderkey % 3 WHEN 0 THEN '640x480' WHEN 1 THEN '1280x720' ELSE '1920x1080' END AS vres",
        "CASE o_orderkey % 4 WHEN 0 THEN '30000/1001' WHEN 1 THEN '25/1' WHEN 2 THEN '24000/1001' ELSE '0/0' END AS fps",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'aac' END AS acodec",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(o_orderkey % 60 AS double) END AS audio_seconds",
        "CASE o_orderkey % 6 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'ultra' WHEN 4 THEN 'odd' ELSE NULL END AS quality",
    )),
    "frames": Derivation("lineitem", (
        "'job-' || cast(l_orderkey AS string) AS job_id",
        "l_linenumber AS n",
        "md5(cast(l_orderkey AS string) || '/' || cast(l_linenumber AS string)) AS etag",
        "CASE (l_orderkey + l_linenumber) % 3 WHEN 0 THEN NULL WHEN 1 THEN md5(cast(l_orderkey AS string) || '/' || cast(l_linenumber AS string)) ELSE 'stale' END AS cache_etag",
    ), distinct=True),
    "attempts": Derivation("lineitem", (
        "l_orderkey AS frame_id", "l_linenumber AS seq", "l_partkey AS p", "l_suppkey AS s", "l_shipdate AS at", "l_returnflag <> 'R' AS ok",
    )),
    "upload_events": Derivation("events", (
        "event_id", "ts",
        "CASE WHEN event_id % 12 = 0 THEN '{\"Records\":[{\"not_s3\":{}}]}' ELSE '{\"Records\":[{\"s3\":{\"bucket\":{\"name\":\"source-bucket\"},\"object\":{\"key\":\"data/src/' || CASE WHEN event_type = 'view' THEN 'anime' ELSE 'real' END || '/u' || cast(user_id AS string) || '/my+clip%20' || cast(event_id AS string) || CASE WHEN event_type = 'error' THEN '.pdf' ELSE '.MP4' END || '\"}}}]}' END AS body",
    )),
    "status_changes": Derivation("events", (
        "'job-' || cast(user_id AS string) AS job_id", "event_id", "ts",
        "CASE event_type WHEN 'signup' THEN 'INITIATED' WHEN 'view' THEN 'EXTRACTING' WHEN 'click' THEN 'PROCESSING' WHEN 'purchase' THEN 'COMPLETED' ELSE 'FAILED' END AS status",
    )),
    "messages": Derivation("events", (
        "'m-' || cast(user_id AS string) || '-' || event_type AS message_id", "event_id AS receive_id", "ts",
    )),
    "warnings": Derivation("events", (
        "event_id", "ts", "'i-' || cast(user_id AS string) AS instance_id",
    ), where="event_type = 'error'"),
    "metrics": Derivation("events", (
        "event_id", "ts", "'i-' || cast(user_id AS string) AS resource_id", "'task-' || cast(user_id % 20 AS string) AS task_id",
        "CASE event_type WHEN 'view' THEN 'CPUUtilization' WHEN 'click' THEN 'Invocations' WHEN 'purchase' THEN 'duration' WHEN 'signup' THEN 'frame_count' ELSE 'error_count' END AS name",
        "CASE event_id % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'upscale' ELSE 'encode' END AS phase",
        "CASE event_id % 2 WHEN 0 THEN 'v1' ELSE 'v2' END AS model_version", "value",
        "'ep-' || cast(user_id % 80 AS string) AS endpoint_name",
    )),
    "instances": Derivation("events", (
        "'i-' || cast(user_id AS string) AS resource_id", "CASE WHEN user_id % 9 = 0 THEN 'stopped' ELSE 'running' END AS state",
        "CASE WHEN user_id % 5 = 0 THEN 'AutoShutdownExclude' WHEN user_id % 5 = 1 THEN 'JobId' ELSE NULL END AS tag_key",
        "CASE WHEN user_id % 5 = 0 THEN 'true' WHEN user_id % 5 = 1 THEN 'job-' || cast(user_id AS string) ELSE NULL END AS tag_value",
    ), distinct=True),
    "volumes": Derivation("orders", (
        "'vol-' || cast(o_orderkey AS string) AS volume_id", "CASE WHEN o_orderstatus = 'F' THEN 'available' ELSE 'in-use' END AS state", "o_orderdate AS create_time",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'KeepOrphaned' ELSE NULL END AS tag_key", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE NULL END AS tag_value",
    ), where="o_orderkey % 10 <> 0"),
    "snapshots": Derivation("lineitem", (
        "'snap-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) AS snapshot_id", "'vol-' || cast(l_orderkey AS string) AS volume_id",
        "l_shipdate AS start_time", "CASE WHEN l_returnflag = 'R' THEN 'KeepOrphaned' ELSE NULL END AS tag_key", "CASE WHEN l_returnflag = 'R' THEN 'true' ELSE NULL END AS tag_value",
    )),
    "endpoints": Derivation("events", (
        "'ep-' || cast(user_id % 80 AS string) AS endpoint_name", "CASE WHEN user_id % 80 % 11 = 0 THEN 'Creating' ELSE 'InService' END AS endpoint_status",
    ), distinct=True),
    "fleet": Derivation("supplier", (
        "s_suppkey AS fleet_id", "(s_suppkey % 6) * cast(0.5 AS double) AS fulfilled", "cast(2 AS bigint) AS target",
    )),
    "costs": Derivation("lineitem", (
        "l_shipdate AS day", "CASE l_returnflag WHEN 'A' THEN 'AmazonEC2' WHEN 'N' THEN 'AmazonS3' ELSE 'AWSLambda' END AS service",
        "'usage-' || l_linestatus AS usage_type", "l_extendedprice AS charge",
    )),
    "evaluations": Derivation("lineitem", (
        "'rule-' || l_returnflag || l_linestatus AS rule_name", "'res-' || cast(l_partkey AS string) AS resource_id", "'bucket' AS resource_type",
        "CASE WHEN l_discount < 0.05 THEN 'COMPLIANT' WHEN l_discount < 0.09 THEN 'NON_COMPLIANT' ELSE 'INSUFFICIENT_DATA' END AS compliance_type",
    )),
    "audit": Derivation("events", (
        "event_id", "ts", "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Client.UnauthorizedOperation' WHEN event_type = 'error' THEN 'AccessDeniedException' ELSE NULL END AS error_code",
        "CASE WHEN event_type = 'purchase' THEN 'Root' ELSE 'IAMUser' END AS user_type", "CASE WHEN event_id % 3 = 0 THEN 'svc' ELSE NULL END AS invoked_by",
        "CASE WHEN event_type = 'signup' THEN 'AttachRolePolicy' ELSE 'GetObject' END AS event_name", "CASE WHEN event_id % 5 = 0 THEN 'AwsServiceEvent' ELSE 'AwsApiCall' END AS event_kind",
    )),
    "requests": Derivation("conversations", (
        "'conv-' || cast(conv_id AS string) AS job_id", "turn AS batch_id", "'s3://test-bucket/in/' || cast(conv_id AS string) || '_' || cast(turn AS string) || '.png' AS input_file_path",
        "CASE WHEN role = 'assistant' THEN 'Yes' WHEN turn % 3 = 0 THEN 'true' ELSE 'no' END AS is_anime", "CASE WHEN turn % 5 = 4 THEN 'yes' ELSE NULL END AS face_enhanced",
        "CASE conv_id % 7 WHEN 0 THEN 'real_sr' WHEN 1 THEN 'classical_sr' WHEN 2 THEN 'lightweight_sr' WHEN 3 THEN 'color_dn' WHEN 4 THEN 'jpeg_car' WHEN 5 THEN 'unknown' ELSE NULL END AS model_variant",
        "cast(conv_id * 5 + turn AS bigint) AS image_id",
    )),
    "payloads": Derivation("documents", ("doc_id", "text")),
    "bench_runs": Derivation("lineitem", (
        "CASE l_linenumber % 3 WHEN 0 THEN 'small_video.mp4' WHEN 1 THEN 'medium_video.mp4' ELSE 'large_video.mp4' END AS video_name",
        "CASE l_linenumber % 3 WHEN 0 THEN '480p' WHEN 1 THEN '720p' ELSE '1080p' END AS resolution", "CASE l_linenumber % 3 WHEN 0 THEN 5 WHEN 1 THEN 10 ELSE 30 END AS duration",
        "CASE WHEN l_linestatus = 'F' THEN 'model_a' ELSE 'model_b' END AS model", "l_quantity AS extraction_time", "l_quantity * 2 AS upscale_time", "l_quantity * 3 AS recompose_time",
    )),
}

# Images: 64 floats in [-1, 1] become an 8x8 gray image or a 4x4 image of four interleaved channels.
_VALUE = "floor((cast(e AS double) + 1) / 2 * 255)"
_PIXELS = (
    "SELECT vec_id AS image_id, cast(floor(i / {row}.0) AS int) AS y, cast(floor(i % {row} / {ch}.0) AS int) AS x, cast(i % {ch} AS int) AS c, {value} AS v "
    "FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) t"
)
PIXEL_SQL = {
    "pixels": _PIXELS.format(row=8, ch=1, value=_VALUE),
    "bgra": _PIXELS.format(row=16, ch=4, value=_VALUE),
}
_SHAPES = {"pixels": (8, 8, 1), "bgra": (4, 4, 4)}


def cte(*names: str, **more: str) -> str:
    """``WITH`` clause text holding the named derivations, then any further named selects."""
    parts = [f"{n} AS ({DERIVED[n].text() if n in DERIVED else PIXEL_SQL[n]})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in more.items()]
    return "WITH " + ", ".join(parts)


class Tables:
    """The driver tables of one folder and everything derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables hold zone-less UTC times
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream_raw(self, name: str, **options: str) -> DataFrame:
        reader = self.spark.readStream.schema(self.raw(name).schema).option("pathGlobFilter", f"{name}.parquet")
        return reader.options(**options).parquet(self.sf_dir)

    def __call__(self, name: str) -> DataFrame:
        return DERIVED[name].apply(self.raw(DERIVED[name].table))

    def stream(self, name: str, **options: str) -> DataFrame:
        return DERIVED[name].apply(self.stream_raw(DERIVED[name].table, **options))

    def images(self, kind: str = "pixels") -> DataFrame:
        h, w, c = _SHAPES[kind]
        return self.raw("embeddings").select(
            F.col("vec_id").alias("image_id"),
            F.lit(h).alias("h"), F.lit(w).alias("w"), F.lit(c).alias("c"),
            F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) / 2 * 255).cast("double")).alias("data"),
        )
