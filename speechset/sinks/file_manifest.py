"""A table of the files that were written, kept by the writer, so that nobody needs to list folders to know them."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.session import file_system
from speechset.sinks.audio_files import write_audio_files
from speechset.sources.files import list_files

MANIFEST = "_manifest"
_COLUMNS = "path string, n_bytes bigint, n_samples bigint, sampling_rate int, error string"
# Header of the files that are written here, and bytes of a sample.
HEADER_BYTES, SAMPLE_BYTES = 44, 2


def hashed_path(path: Column, digits: int = 3) -> Column:
    """``path`` below a folder of the first ``digits`` hex digits of its digest: 16 ** digits folders of like size, where one
    folder of all files would be slow to open and to write to."""
    return F.concat(F.substr(F.md5(path), F.lit(1), F.lit(digits)), F.lit("/"), path)


def write_with_manifest(df: DataFrame, folder: str, path: str = "path", audio: str = "audio") -> DataFrame:
    """Write each row's clip to ``folder/<path>`` and append a row for each to the manifest; returns the rows of this write.

    The files are written by the tasks of the one write that commits the rows: rows appear only when all files are there. A
    write that is stopped leaves files without rows, which ``check_files`` finds and the next write replaces. A clip that could not be
    written is a row with its error and no size; rows without a path or samples write nothing and leave no row."""
    spark = df.sparkSession
    before = _batches(spark, folder)
    report = write_audio_files(df.withColumn("_hz", F.col(audio)["sampling_rate"]).select(path, audio, "_hz"), folder, path, audio)
    rows = report.where((F.col("error") != "") | F.col("n_samples").isNotNull()).select(
        F.col(path).alias("path"),
        (F.col("n_samples") * SAMPLE_BYTES + HEADER_BYTES).alias("n_bytes"),
        "n_samples",
        F.col("_hz").cast("int").alias("sampling_rate"),
        "error",
    )
    batch = before + 1
    rows.write.parquet(f"{folder}/{MANIFEST}/batch={batch}")
    return spark.read.schema(_COLUMNS).parquet(f"{folder}/{MANIFEST}/batch={batch}")


def _stored(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_COLUMNS}, batch bigint").parquet(f"{folder}/{MANIFEST}")
    except PySparkException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _batches(spark: SparkSession, folder: str) -> int:
    """The last batch number that was ever used, also by a write that was stopped."""


    store, place = file_system(f"{folder}/{MANIFEST}")
    if not store.exists(place):
        return 0
    names = [status.getPath().getName() for status in store.listStatus(place)]  # one entry a write
    return max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), default=0)


def written_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, n_bytes, n_samples, sampling_rate`` of the files in ``folder`` by its manifest: the last write of each path."""
    stored = _stored(spark, folder)
    if stored is None:
        return spark.createDataFrame([], "path string, n_bytes bigint, n_samples bigint, sampling_rate int")
    good = stored.where(F.col("error") == "")
    last = good.groupBy("path").agg(F.max_by(F.struct("n_bytes", "n_samples", "sampling_rate"), "batch").alias("f"))
    return last.select("path", "f.*")


def check_files(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """``path, problem`` where the manifest and the folder differ: ``missing`` and ``size`` by the manifest, ``unlisted`` by the
    folder. This lists the folder; writing and resuming do not."""
    known = written_files(spark, folder).select("path", "n_bytes")
    try:
        found = list_files(spark, folder, pattern)
    except PySparkException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, length bigint")
    both = known.join(found, "path", "full")
    problem = F.when(F.col("length").isNull(), "missing").when(F.col("n_bytes").isNull(), "unlisted").when(F.col("length") != F.col("n_bytes"), "size")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")
