"""Reading metadata files: CSV, JSON Lines and sentence catalogues."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from speechset.session import small_table

log = logging.getLogger(__name__)

# Fields may hold quotes, line breaks and outer spaces; quotes are doubled.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_metadata_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Metadata with every column as text and blanks for missing fields. Texts such as ``NA`` stay
    texts. With ``columns`` the header is not read to find the names."""
    reader = spark.read.options(**CSV_OPTIONS)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path).na.fill("")


def read_typed_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Metadata with declared types, or inferred ones (an extra pass) if no schema is given."""
    reader = spark.read.options(**CSV_OPTIONS)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_prior_metadata(
    spark: SparkSession, path: str, columns: list[str], warn: Callable[[str], None] | None = None
) -> DataFrame:
    """Metadata of an earlier run; an empty table and a warning if there is none or its header lacks the
    needed columns. Any other fault (permission, network) is the caller's to see. ``warn`` is called with the
    warning where there is something, but not an earlier run; it is logged in any case."""
    try:
        found = spark.read.options(**CSV_OPTIONS).csv(path)
        if not {"_key", "cloned_audio_fr"} <= set(found.columns):
            raise ValueError(f"columns {found.columns}")
        return read_metadata_csv(spark, path, found.columns)
    except (PySparkException, ValueError) as failure:
        absent = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if isinstance(failure, PySparkException) and failure.getCondition() not in absent:
            raise
        message = f"no usable earlier run at {path} ({str(failure).splitlines()[0]}); starting fresh"
        log.warning("%s", message)
        if warn is not None and not (isinstance(failure, PySparkException) and failure.getCondition() == "PATH_NOT_FOUND"):
            warn(message)
        return small_table(spark, [], ", ".join(f"`{c}` string" for c in columns))


def read_metadata_json(spark: SparkSession, path: str, schema: str, array: bool = False) -> DataFrame:
    """JSON Lines, or with ``array`` one JSON array per file."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_catalogue(spark: SparkSession, path: str, default: DataFrame | None = None) -> DataFrame:
    """Sentences ``lang, sample_index, text`` from ``{lang: [sentence, ...]}`` files.

    ``default`` (same columns) is used if the path does not exist.
    """
    try:
        raw = spark.read.text(path, wholetext=True)
    except PySparkException as failure:
        if default is None or failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return default.select("lang", "sample_index", "text")
    return sentences_of(raw.select(F.from_json("value", "map<string,array<string>>").alias("catalogue")))


def sentences_of(catalogues: DataFrame, column: str = "catalogue") -> DataFrame:
    """One row per sentence of a ``map<lang, array<sentence>>`` column."""
    langs = catalogues.select(F.explode(column).alias("lang", "sentences"))
    rows = langs.select("lang", F.posexplode("sentences").alias("sample_index", "text"))
    return rows.withColumn("sample_index", F.col("sample_index").cast("bigint"))
