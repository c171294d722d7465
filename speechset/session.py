"""Session settings, the shared work folder and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Largest table that is ever broadcast by an explicit hint, in rows, and largest list the driver reads.
BROADCAST_ROWS = 10_000
LIST_ROWS = 10_000

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # An audio row can weigh a megabyte: bound an Arrow batch by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Clip files are small: do not weigh the opening of one like four megabytes of reading.
    "spark.sql.files.openCostInBytes": str(512 * 1024),
}

_fallback_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the operators assume."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "speechset", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _fallback_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        _fallback_roots[app] = tempfile.mkdtemp(prefix="speechset-")
    return _fallback_roots[app]


def file_system(folder: str):
    """The Hadoop file system of ``folder`` and its path there."""
    spark = SparkSession.active()
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def qualified(folder: str) -> str:
    """``folder`` with its scheme and host, as Spark and every task must name it: a path without a scheme
    is on the session's default file system, not on the disk of whoever opens it."""
    store, path = file_system(folder)
    return store.makeQualified(path).toString().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so later plans start from files."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list from the driver as a local relation, whose size the optimizer knows."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = [pa.array([row[i] for row in rows], type=field.type) for i, field in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields))


def bounded_rows(df: DataFrame, limit: int = LIST_ROWS) -> list:
    """Rows of a small table on the driver; an error, never a cut, when it is larger than ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where a short list is expected")
    return rows


def bounded_list(df: DataFrame, column: str, limit: int = LIST_ROWS) -> list:
    return [row[0] for row in bounded_rows(df.select(column), limit)]
