"""Schema work, names, records and checks of single rows."""

from pyspark.sql import functions as F

from speechset.functions.naming import (
    cloned_clip_name,
    file_key,
    indexed_clip_name,
    indexed_source_name,
    resume_key,
    source_clip_name,
    under,
)
from speechset.functions.text import first_existing, is_blank, preview, strip
from speechset.operators.jobs import cfg_weight
from speechset.operators.shape import (
    SourceProfile,
    canonical_metadata,
    clip_record,
    publishable,
    rename_over,
    select_profile,
)
from speechset.operators.validity import mark_errors
from speechset.plans.repair import join_by_position, repair_metadata
from suite.fixtures import audio, prior, table, utt, wide
from suite.registry import query


@query(
    """SELECT source, slot, md5(coalesce(text_en, '')) AS reference_text, md5(text_fr) AS text_fr, md5(text_de) AS text_de,
              source AS speaker_id FROM wide""",
    ("wide",),
)
def q_profile_select(spark, sf_dir):
    """A source profile maps physical columns to their roles; a language without a column is left out."""
    profile = SourceProfile(
        audio="clip",
        reference_text="text_en",
        texts={"fr": "text_fr", "de": "text_de", "zh": "text_zh"},
        speaker="source",
    )
    logical = select_profile(wide(spark, sf_dir), profile, keep=["source", "slot"])
    hashed = {c: F.md5(c) for c in ("reference_text", "text_fr", "text_de")}
    return logical.withColumns(hashed).drop("row_id")


@query(
    """SELECT original_split || ':' || original_index AS _key, 'original_' || original_split || '_' || original_index || '_en.wav' AS source_name,
              'original_audio_en/cloned_' || original_split || '_' || original_index || '_fr.wav' AS cloned_path,
              original_split || '_' || original_index AS file_key,
              printf('original_%05d.wav', original_index) AS indexed_source,
              printf('cloned_%05d_%s.wav', original_index, lang) AS indexed_clip
       FROM utt""",
    ("utt",),
)
def q_filenames(spark, sf_dir):
    key = resume_key(F.col("original_split"), F.col("original_index"))
    return utt(spark, sf_dir).select(
        key.alias("_key"),
        source_clip_name(key).alias("source_name"),
        under("original_audio_en", cloned_clip_name(key)).alias("cloned_path"),
        file_key(key).alias("file_key"),
        indexed_source_name(F.col("original_index")).alias("indexed_source"),
        indexed_clip_name(F.col("original_index"), F.col("lang")).alias("indexed_clip"),
    )


@query(
    """SELECT original_split || ':' || original_index AS _key, u.speaker_id, '' AS speaker_name, original_split,
              original_index, md5(CASE WHEN lang = 'en' THEN text ELSE '' END) AS text_en,
              md5(CASE WHEN lang = 'fr' THEN text ELSE '' END) AS text_fr, '' AS audio_en,
              coalesce(cloned_audio_fr, '') AS cloned_audio_fr, coalesce(error, '') AS error
       FROM utt u LEFT JOIN prior p USING (doc_id)""",
    ("utt", "prior"),
)
def q_clip_record(spark, sf_dir):
    """The ten-column record; absent columns and nulls are blank."""
    rows = utt(spark, sf_dir).join(prior(spark, sf_dir), "doc_id", "left")
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("text")) for lang in ("en", "fr")}
    key = resume_key(F.col("original_split"), F.col("original_index"))
    record = clip_record(rows.withColumns({**texts, "_key": key}))
    return record.withColumns({c: F.md5(c) for c in texts})


_VOICES = "CASE WHEN text_fr IS NOT NULL THEN 'voice/' || source || '_' || slot || '_fr.wav' END"


@query(
    f"""SELECT md5(coalesce(text_en, '')) AS text_en, '' AS voice_en, md5(coalesce(text_fr, '')) AS text_fr,
               coalesce({_VOICES}, '') AS voice_fr, source, slot, md5(text_de) AS text_de, md5(text_es) AS text_es,
               'text_en,voice_en,text_fr,voice_fr,source,slot,text_de,text_es' AS column_order
        FROM wide""",
    ("wide",),
)
def q_wide_normalise(spark, sf_dir):
    """Old names to text and voice pairs in language order, the other columns after them."""
    old = wide(spark, sf_dir).withColumnRenamed("text_en", "source_text_en").withColumn(
        "cloned_voice_fr",
        F.when(F.col("text_fr").isNotNull(), F.concat(F.lit("voice/"), "source", F.lit("_"), "slot", F.lit("_fr.wav"))),
    )
    new = canonical_metadata(old, ["en", "fr"])
    hashed = {c: F.md5(c) for c in new.columns if c.startswith("text_")}
    return new.withColumns({**hashed, "column_order": F.lit(",".join(new.columns))})


@query("SELECT doc_id, md5(text) AS body FROM documents")
def q_rename_collide(spark, sf_dir):
    """Rename onto a name that is taken: the old holder goes. Absent names are skipped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("body"))
    renamed = rename_over(docs, {"text": "body", "absent": "other", "doc_id": "doc_id"})
    return renamed.withColumn("body", F.md5("body"))


@query(
    "SELECT doc_id, CASE WHEN quality = 1 THEN 'cloned_' || doc_id END AS voice FROM labels",
)
def q_legacy_coalesce(spark, sf_dir):
    """The first existing of two names; its nulls are kept although the second has values."""
    rows = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.concat(F.lit("cloned_"), "doc_id")).alias("cloned_voice_fr"),
        F.concat(F.lit("voice_"), "doc_id").alias("voice_fr"),
    )
    return rows.select("doc_id", first_existing(rows, "gone", "cloned_voice_fr", "voice_fr").alias("voice"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN cloned_audio_fr <> '' THEN '/corpus/train/' || cloned_audio_fr END
              AS cloned_audio_fr, error, CAST(toxic AS VARCHAR) AS audio_length_samples FROM prior""",
    ("prior",),
)
def q_publish_paths(spark, sf_dir):
    """Published form: internal columns gone, audio paths absolute or null, all else text."""
    rows = prior(spark, sf_dir).withColumn("_key", F.concat(F.lit("dev:"), "doc_id"))
    return publishable(rows.withColumnRenamed("toxic", "audio_length_samples"), "/corpus/train/")


@query("SELECT doc_id, substring(text, 1, 60) AS preview FROM documents")
def q_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", preview(F.col("text"), 60).alias("preview"))


@query("SELECT vec_id, greatest(CAST(label AS DOUBLE) / 10, 0.001::DOUBLE) AS cfg FROM embeddings")
def q_job_params(spark, sf_dir):
    """The guidance weight of every row, never zero."""
    weight = cfg_weight(F.col("label") / 10.0)
    return table(spark, sf_dir, "embeddings").select("vec_id", weight.alias("cfg"))


@query(
    """SELECT d.doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS stripped,
              regexp_full_match(text, '\\s*') AS blank FROM documents d""",
)
def q_strip_text(spark, sf_dir):
    """Whole texts without outer white space, and the blank test."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(strip(F.col("text"))).alias("stripped"), is_blank(F.col("text")).alias("blank"))


@query(
    """WITH rows AS (SELECT d.doc_id, CASE lang WHEN 'fr' THEN text WHEN 'de' THEN ' \t\n' END AS text_fr, a."array"
                     FROM documents d LEFT JOIN audio a USING (doc_id))
       SELECT doc_id, CASE WHEN "array" IS NULL OR len("array") = 0 THEN 'missing or empty source audio'
                           WHEN regexp_full_match(coalesce(text_fr, ''), '\\s*') THEN 'missing French text'
                           ELSE '' END AS error FROM rows""",
    ("audio",),
)
def q_validity_errors(spark, sf_dir):
    text = F.when(F.col("lang") == "fr", F.col("text")).when(F.col("lang") == "de", " \t\n")
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("text_fr"))
    joined = rows.join(audio(spark, sf_dir), "doc_id", "left")
    return mark_errors(joined).select("doc_id", "error")


@query(
    """WITH a AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings),
            d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
       SELECT pos, doc_id, vec_id FROM a JOIN d USING (pos)""",
)
def q_positional_repair(spark, sf_dir):
    """The n-th clip with the n-th document."""
    clips = table(spark, sf_dir, "embeddings").select("vec_id")
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return join_by_position(clips, docs, "vec_id", "doc_id")


@query(
    """WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
            a AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings)
       SELECT md5(text) AS text_en, CASE WHEN vec_id IS NULL THEN '' ELSE printf('cloned_audio/en/original_%05d.wav', pos) END AS voice_en,
              '' AS text_ar, '' AS voice_ar, '' AS text_fr, '' AS voice_fr, pos, doc_id, vec_id
       FROM d LEFT JOIN a USING (pos)""",
)
def q_job_repair(spark, sf_dir):
    """Old metadata repaired from its source table by position."""
    metadata = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source_text_en"))
    sources = table(spark, sf_dir, "embeddings").select("vec_id")
    return repair_metadata(metadata, sources, "doc_id", "vec_id").withColumn("text_en", F.md5("text_en"))
