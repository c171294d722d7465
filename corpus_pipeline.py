"""From raw documents to packed training sequences, a stage at a time."""

from __future__ import annotations

import pathlib
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(pathlib.Path(__file__).resolve().parent)
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

import public_tokenizers  # noqa: E402

from speechset.llm.frames import prepare, table  # noqa: E402
from speechset.llm.neardup import first_of_groups  # noqa: E402
from speechset.llm.packing import pack  # noqa: E402
from speechset.llm.quality import quality_kept  # noqa: E402
from speechset.llm.substrings import remove_repeats  # noqa: E402
from speechset.llm.toxicity import fit, without_toxic  # noqa: E402
from speechset.session import new_folder  # noqa: E402

# Words of a shingle in the near-duplicate stage; the four of op9's contract bind that query only.
SHINGLE = 5

# SQL has no estimate of covariance determinants and no trained classifier.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    prepare(spark)
    return quality_kept(docs)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labels of those that came here."""
    prepare(spark)
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, in one row however often it is repeated."""
    prepare(spark)
    return first_of_groups(docs, size=SHINGLE, once=True)


def remove_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated windows; a text that loses all its words is empty."""
    prepare(spark)
    done = remove_repeats(docs)
    return done if "n_chars" not in done.columns else _recount(done)


def _recount(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their place in a sequence of 2048 tokens."""
    prepare(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("toxicity", keep_civil),
    ("MinHash near-dedup", keep_first_copies),
    ("substring dedup", remove_substrings),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        path = new_folder(spark, "stage")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
