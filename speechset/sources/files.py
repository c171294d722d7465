"""File listings, split discovery and audio files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.constants import METADATA_CANDIDATES
from speechset.functions.audio import audio_value, decode_files
from speechset.session import qualified


def relative_to(path: Column, root: str) -> Column:
    """``path`` below ``root``, named as given or as the session's file systems name it; null for any
    other path."""
    result = F.lit(None).cast("string")
    for base in (root.rstrip("/") + "/", qualified(root) + "/"):
        result = F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(result)
    return result


def list_files(spark: SparkSession, root: str, pattern: str = "*", paths: Sequence[str] | None = None) -> DataFrame:
    """``path`` (relative) and ``length`` of the files below ``root``; no file is opened.

    ``paths`` are globs below ``root`` that narrow the listing, such as ``*/cloned_audio_fr``.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load([f"{root}/{p}" for p in paths] if paths else root)
    )
    return found.select(relative_to(F.col("path"), root).alias("path"), "length")


def _present(home: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    from speechset.sinks.audio_files import open_filesystem

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_filesystem(home)
        for batch in batches:
            paths = [p for p in batch.column("path").to_pylist() if p]
            facts = store.get_file_info([f"{base}/{p}" for p in paths]) if paths else []
            here = [(p, f.size) for p, f in zip(paths, facts) if f.type == FileType.File]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in here], pa.string()), pa.array([n for _, n in here], pa.int64())], names=["path", "length"]
            )

    return run


def present_files(paths: DataFrame, root: str) -> DataFrame:
    """``path, length`` of those ``path`` values whose file below ``root`` exists. Each is asked for by the task that holds it, so
    no folder is listed, and the driver sees none of them."""
    return paths.select("path").mapInArrow(_present(qualified(root)), "path string, length bigint")


def read_audio_files(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """``path, audio, channels, error`` of the audio files below ``root``."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(relative_to(F.col("path"), root).alias("path"), "content")
    )
    schema = "path string, array array<float>, sampling_rate int, channels int, error string"
    decoded = found.mapInArrow(decode_files, schema)
    return decoded.select("path", audio_value(F.col("array"), F.col("sampling_rate")).alias("audio"), "channels", "error")


def discover_splits(listing: DataFrame, candidates: Sequence[str] = METADATA_CANDIDATES) -> DataFrame:
    """``split, folder, file`` from a listing of relative paths, in split order.

    Each sub-directory that holds a candidate is a split, the best-ranked file wins. Only if there is
    none does a candidate in the root count, as split ``train``. A candidate may be a file or the
    folder of part files that Spark writes.
    """
    names = F.array(*[F.lit(c) for c in candidates])
    parts = F.split("path", "/")
    placed = listing.select(
        parts[0].alias("_first"),
        F.nullif(F.array_position(names, parts[0]), F.lit(0)).alias("_root_rank"),
        F.nullif(F.array_position(names, F.try_element_at(parts, F.lit(2))), F.lit(0)).alias("_rank"),
    )
    # One row per top-level entry with a candidate; both cases below read this one aggregate.
    entries = (
        placed.where("_rank IS NOT NULL OR _root_rank IS NOT NULL")
        .groupBy("_first")
        .agg(F.min(F.when(F.col("_root_rank").isNull(), F.col("_rank"))).alias("_best"), F.min("_root_rank").alias("_root"))
    )
    below = entries.where("_best IS NOT NULL").select(
        F.col("_first").alias("split"),
        F.col("_first").alias("folder"),
        F.element_at(names, F.col("_best").cast("int")).alias("file"),
    )
    summary = entries.agg(F.count("_best").alias("_splits"), F.min("_root").alias("_root"))
    root = summary.where("_splits = 0 AND _root IS NOT NULL").select(
        F.lit("train").alias("split"),
        F.lit("").alias("folder"),
        F.element_at(names, F.col("_root").cast("int")).alias("file"),
    )
    return below.unionByName(root).orderBy("split")


def list_metadata(spark: SparkSession, root: str) -> DataFrame:
    """The metadata files in ``root`` and its sub-directories, without listing any audio folder."""
    result = None
    for glob in ("*/metadata*.csv", "metadata*.csv"):
        try:
            found = list_files(spark, root, paths=[glob])
        except PySparkException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        result = found if result is None else result.unionByName(found)
    if result is None:
        raise FileNotFoundError(f"no split metadata below {root}")
    return result
