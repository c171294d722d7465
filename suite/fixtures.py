"""Fixture views over the given tables, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.operators.positions import dense_positions

TARGET_LANGS = ["fr", "de", "es"]
ALL_LANGS = ["en", "fr", "de", "es"]

_VIEWS = {
    "utt": """
        SELECT doc_id,
               CASE WHEN doc_id % 2 = 0 THEN 'dev' ELSE 'eval' END AS original_split,
               CAST(floor(doc_id / 2.0) AS BIGINT) AS original_index,
               lang || '_' || source AS speaker_id, lang, text
        FROM documents""",
    "wide": """
        SELECT source, slot,
               max(text) FILTER (WHERE lang = 'en') AS text_en, max(text) FILTER (WHERE lang = 'fr') AS text_fr,
               max(text) FILTER (WHERE lang = 'de') AS text_de, max(text) FILTER (WHERE lang = 'es') AS text_es
        FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS slot FROM documents)
        GROUP BY source, slot""",
    "audio": """
        SELECT vec_id AS doc_id, embedding AS "array",
               CASE WHEN label < 5 THEN 24000 ELSE 16000 END AS sampling_rate
        FROM embeddings""",
    "prior": """
        SELECT d.doc_id,
               CASE WHEN l.quality = 1 THEN 'cloned_' || d.doc_id || '_fr.wav' ELSE '' END AS cloned_audio_fr,
               CASE WHEN l.quality = 1 THEN '' ELSE 'failed' END AS error, l.toxic
        FROM documents d JOIN labels l USING (doc_id)""",
    "codes": """
        SELECT vec_id, vec_id AS doc_id, label,
               list_transform(embedding, lambda x: CAST(floor((CAST(x AS DOUBLE) + 1) * 1000) AS INTEGER)) AS codes
        FROM embeddings""",
}


def with_views(sql: str, views: tuple[str, ...]) -> str:
    if not views:
        return sql
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in views)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ordered splits; natural speakers are language and source."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("eval").alias("original_split"),
        F.expr("doc_id div 2").alias("original_index"),
        F.concat_ws("_", "lang", "source").alias("speaker_id"),
        "lang",
        "text",
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (source, slot), one text column per language, null where absent."""
    slots = dense_positions(
        table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), "doc_id", ["source", "lang"], "slot"
    )
    texts = [F.max(F.when(F.col("lang") == lang, F.col("text"))).alias(f"text_{lang}") for lang in ALL_LANGS]
    return slots.groupBy("source", "slot").agg(*texts)


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample arrays keyed by document, in two sampling rates."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.struct(
            F.col("embedding").alias("array"),
            F.when(F.col("label") < 5, 24000).otherwise(16000).alias("sampling_rate"),
        ).alias("audio"),
    )


def prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier run: quality 1 is a finished clip, 0 a failed one, no label means never tried."""
    labels = table(spark, sf_dir, "labels")
    good = F.col("quality") == 1
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id")
        .join(labels, "doc_id")
        .select(
            "doc_id",
            F.when(good, F.format_string("cloned_%d_fr.wav", "doc_id")).otherwise("").alias("cloned_audio_fr"),
            F.when(good, "").otherwise("failed").alias("error"),
            "toxic",
        )
    )


def codec_codes(column: str) -> Column:
    return F.transform(column, lambda x: F.floor((x.cast("double") + 1) * 1000).cast("int"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codec codes, one list per embedding."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("vec_id").alias("doc_id"), "label", codec_codes("embedding").alias("codes")
    )
