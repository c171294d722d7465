"""Sources and sinks: every query writes in the shared folder and reads back what it wrote."""

from pyspark.sql import functions as F

from speechset.constants import METADATA_CANDIDATES
from speechset.functions.audio import resample_audio, sample_count
from speechset.operators.shape import SourceProfile, union_splits
from speechset.plans.publish import publish_dataset
from speechset.session import new_folder
from speechset.sinks.audio_files import require_written, write_audio_files
from speechset.sinks.file_manifest import check_files, hashed_path, write_with_manifest, written_files
from speechset.sinks.metadata import write_metadata_csv, write_metadata_json
from speechset.sinks.publish import dataset_manifest, write_dataset
from speechset.sources.audio_blocks import read_audio_blocks, read_audio_headers
from speechset.sources.files import discover_splits, list_files, read_audio_files, relative_to
from speechset.sources.metadata import read_metadata_csv, read_metadata_json, read_prior_metadata, read_typed_csv
from speechset.sources.tables import load_split, load_splits, peek, schema_profile
from suite.fixtures import audio, prior, table, utt
from suite.registry import query


def _write_splits(spark, sf_dir):
    root = new_folder(spark, "utterances")
    write_dataset(utt(spark, sf_dir).withColumnRenamed("original_split", "split"), root)
    return root


@query("SELECT doc_id, speaker_id FROM utt WHERE original_split = 'dev'", ("utt",))
def q_load_split(spark, sf_dir):
    """One split of a partitioned dataset; the folders of the others are not read."""
    return load_split(spark, _write_splits(spark, sf_dir), "dev").select("doc_id", "speaker_id")


@query(
    """SELECT 'named' AS request, doc_id, original_split AS split FROM utt
       UNION ALL SELECT 'default', doc_id, original_split FROM utt WHERE original_split = 'eval'""",
    ("utt",),
)
def q_load_splits(spark, sf_dir):
    """Several named splits, and the profile's default split when none is named."""
    root = _write_splits(spark, sf_dir)
    profile = SourceProfile(audio="audio", reference_text="text", default_split="eval")
    named = load_splits(spark, root, ["dev", "eval"]).select(F.lit("named").alias("request"), "doc_id", "split")
    default = load_splits(spark, root, None, profile).select(F.lit("default").alias("request"), "doc_id", "split")
    return named.unionByName(default)


@query("SELECT doc_id, lang FROM utt WHERE original_split = 'dev' ORDER BY original_index LIMIT 1", ("utt",))
def q_peek(spark, sf_dir):
    return peek(utt(spark, sf_dir).where("original_split = 'dev'"), "original_index").select("doc_id", "lang")


@query(
    """SELECT 'doc_id' AS column_name, 'bigint' AS data_type, count(doc_id) AS n_values FROM documents
       UNION ALL SELECT 'text', 'string', count(text) FROM documents
       UNION ALL SELECT 'lang', 'string', count(lang) FROM documents
       UNION ALL SELECT 'source', 'string', count(source) FROM documents
       UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM documents""",
)
def q_schema_profile(spark, sf_dir):
    return schema_profile(table(spark, sf_dir, "documents"))


def _prior_with_text(spark, sf_dir):
    text = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prior(spark, sf_dir).drop("toxic").join(text, "doc_id")


_PRIOR_TEXT = """SELECT {id} AS doc_id, cloned_audio_fr, error, md5(text) AS text
                 FROM prior JOIN documents d USING (doc_id)"""


@query(_PRIOR_TEXT.format(id="CAST(doc_id AS VARCHAR)"), ("prior",))
def q_csv_roundtrip(spark, sf_dir):
    """Metadata with whole texts (line breaks, quotes) through CSV, all columns as text."""
    path = new_folder(spark, "metadata.csv")
    write_metadata_csv(_prior_with_text(spark, sf_dir), path, order_by=["doc_id"])
    return read_metadata_csv(spark, path).withColumn("text", F.md5("text"))


@query(
    f"""SELECT 'declared' AS types, * FROM ({_PRIOR_TEXT.format(id="doc_id")})
        UNION ALL SELECT 'inferred', * FROM ({_PRIOR_TEXT.format(id="doc_id")})""",
    ("prior",),
)
def q_csv_typed(spark, sf_dir):
    """The same with declared and with inferred types."""
    path = new_folder(spark, "metadata.csv")
    write_metadata_csv(_prior_with_text(spark, sf_dir), path)
    schema = "doc_id bigint, cloned_audio_fr string, error string, text string"

    def report(df, name):
        hashed = df.na.fill("").withColumn("text", F.md5("text"))
        return hashed.select(F.lit(name).alias("types"), F.col("doc_id").cast("bigint").alias("doc_id"), "cloned_audio_fr", "error", "text")

    declared = report(read_typed_csv(spark, path, schema), "declared")
    return declared.unionByName(report(read_typed_csv(spark, path), "inferred"))


@query(
    "SELECT doc_id, lang, md5(CASE WHEN lang = 'fr' THEN text END) AS text_fr, lang = 'fr' AS has_text FROM documents",
)
def q_json_roundtrip(spark, sf_dir):
    """Whole texts through JSON Lines; nulls are kept as nulls."""
    path = new_folder(spark, "metadata.json")
    french = F.when(F.col("lang") == "fr", F.col("text")).alias("text_fr")
    write_metadata_json(table(spark, sf_dir, "documents").select("doc_id", "lang", french), path)
    back = read_metadata_json(spark, path, "doc_id bigint, lang string, text_fr string")
    return back.select("doc_id", "lang", F.md5("text_fr").alias("text_fr"), F.col("text_fr").isNotNull().alias("has_text"))


@query(
    "SELECT 'dev:' || doc_id AS _key, cloned_audio_fr, error FROM prior",
    ("prior",),
)
def q_prior_metadata(spark, sf_dir):
    """Metadata of an earlier run, and nothing for a run whose metadata cannot be used."""
    path, broken = new_folder(spark, "metadata.csv"), new_folder(spark, "broken.csv")
    rows = prior(spark, sf_dir)
    write_metadata_csv(rows.select(F.concat(F.lit("dev:"), "doc_id").alias("_key"), "cloned_audio_fr", "error"), path)
    write_metadata_csv(rows.select("error"), broken)
    columns = ["_key", "cloned_audio_fr", "error"]
    parts = [read_prior_metadata(spark, p, columns).select(*columns) for p in (path, broken, new_folder(spark, "absent"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _write_clips(spark, sf_dir):
    folder = new_folder(spark, "clips")
    paths = audio(spark, sf_dir).withColumn("path", F.format_string("audio/clip_%d.wav", "doc_id"))
    require_written(write_audio_files(paths, folder))
    return folder


@query(
    """SELECT doc_id, CAST(len("array") AS BIGINT) AS n_samples, sampling_rate, 1 AS channels,
              CAST(list_sum(list_transform("array", lambda x: round_even(CAST(x AS DOUBLE) * 32767, 0))) AS BIGINT) AS pcm_sum, '' AS error
       FROM audio""",
    ("audio",),
)
def q_audio_files(spark, sf_dir):
    """Every clip as a WAV file, read back and decoded."""
    files = read_audio_files(spark, _write_clips(spark, sf_dir))
    pcm = F.transform("audio.array", lambda x: F.round(x.cast("double") * 32768).cast("bigint"))
    return files.select(
        F.regexp_extract("path", r"clip_(\d+)\.wav", 1).cast("bigint").alias("doc_id"),
        F.size("audio.array").cast("bigint").alias("n_samples"),
        "audio.sampling_rate",
        "channels",
        F.aggregate(pcm, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("pcm_sum"),
        "error",
    )


@query(
    """SELECT doc_id, sampling_rate, 1 AS channels, 16 AS bits, CAST(len("array") AS BIGINT) AS n_frames,
              round(len("array") / sampling_rate, 9) AS seconds, CAST(44 AS BIGINT) AS header_bytes FROM audio""",
    ("audio",),
)
def q_audio_headers(spark, sf_dir):
    """Rate, channels and length of every clip file from its header; no sample is read."""
    facts = read_audio_headers(spark, _write_clips(spark, sf_dir))
    return facts.select(
        F.regexp_extract("path", r"clip_(\d+)\.wav", 1).cast("bigint").alias("doc_id"),
        "sampling_rate", "channels", "bits", "n_frames", F.round("seconds", 9).alias("seconds"), "header_bytes",
    )


@query(
    """SELECT doc_id, CAST(ceil(len("array") / 24) AS BIGINT) AS n_blocks, CAST(ceil(len("array") * 8000 / sampling_rate) AS BIGINT) AS n_samples,
              true AS whole, 8000 AS sampling_rate FROM audio""",
    ("audio",),
)
def q_audio_blocks(spark, sf_dir):
    """Every clip file in blocks of 24 samples, each resampled from its own bytes, against the whole clip."""
    folder = _write_clips(spark, sf_dir)
    blocks = read_audio_blocks(spark, folder, target=8000, block_frames=24)
    clips = blocks.groupBy("path", "sampling_rate").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("first", "array"))), lambda b: b["array"])).alias("array")
    )
    whole = read_audio_files(spark, folder).select("path", resample_audio(F.col("audio"), 8000)["array"].alias("expected"))
    near = F.forall(F.arrays_zip("array", "expected"), lambda p: F.abs(p["array"] - p["expected"]) < 1e-6)
    return clips.join(whole, "path").select(
        F.regexp_extract("path", r"clip_(\d+)\.wav", 1).cast("bigint").alias("doc_id"),
        "n_blocks", F.size("array").cast("bigint").alias("n_samples"), near.alias("whole"), "sampling_rate",
    )


@query(
    """SELECT 'audio/clip_' || doc_id || '.wav' AS path, CAST(44 + 2 * len("array") AS BIGINT) AS length FROM audio""",
    ("audio",),
)
def q_file_listing(spark, sf_dir):
    """Existing clip files with their sizes; no file is opened."""
    return list_files(spark, _write_clips(spark, sf_dir), "*.wav")


@query(
    """WITH c AS (SELECT substr(md5('clip_' || doc_id || '.wav'), 1, 2) || '/clip_' || doc_id || '.wav' AS path, doc_id,
                         CAST(len("array") AS BIGINT) AS n_samples, sampling_rate FROM audio)
       SELECT path, CAST(44 + 2 * n_samples AS BIGINT) AS n_bytes, n_samples, sampling_rate, '' AS problem FROM c WHERE sampling_rate = 24000
       UNION ALL SELECT path, -1, -1, -1, CASE WHEN doc_id % 2 = 0 THEN 'unlisted' ELSE 'missing' END FROM c WHERE sampling_rate = 16000
       UNION ALL SELECT path, 44 + 2 * n_samples, n_samples, sampling_rate, 'size' FROM c WHERE sampling_rate = 24000 AND doc_id % 2 = 1""",
    ("audio",),
)
def q_file_manifest(spark, sf_dir):
    """The manifest of written clips in hash folders, and what differs from the folder: some files are written past the
    manifest, some of its files are not there, and some were replaced by others of another length."""
    folder = new_folder(spark, "files")
    clips = audio(spark, sf_dir).withColumn("path", hashed_path(F.format_string("clip_%d.wav", "doc_id"), 2))
    high, odd = F.col("audio.sampling_rate") == 24000, F.col("doc_id") % 2 == 1
    write_with_manifest(clips.where(high & odd), folder)
    write_with_manifest(clips.where(high), folder)  # half of them again
    require_written(write_audio_files(clips.where(~high & ~odd), folder))
    short = F.struct(F.slice("audio.array", 1, 1).alias("array"), F.col("audio.sampling_rate").alias("sampling_rate"))
    require_written(write_audio_files(clips.where(high & odd).withColumn("audio", short), folder))
    elsewhere = new_folder(spark, "elsewhere")
    lost = write_with_manifest(clips.where(~high & odd), elsewhere)
    lost.write.parquet(f"{folder}/_manifest/batch=3")
    nothing = F.lit(-1).cast("bigint")
    problems = check_files(spark, folder)
    known = written_files(spark, folder).join(problems.where("problem = 'missing'").select("path"), "path", "left_anti")
    return known.withColumn("problem", F.lit("")).unionByName(
        problems.join(written_files(spark, folder), "path", "left").select(
            "path", *[F.when(F.col("problem") == "size", F.col(c)).otherwise(nothing).alias(c) for c in ("n_bytes", "n_samples")],
            F.when(F.col("problem") == "size", F.col("sampling_rate")).otherwise(-1).alias("sampling_rate"), "problem",
        )
    )


_RANKS = ", ".join(f"('{name}', {rank})" for rank, name in enumerate(METADATA_CANDIDATES))


@query(
    f"""WITH ranks AS (SELECT * FROM (VALUES {_RANKS}) AS r(file, rank)),
    listing AS (SELECT lang || '_' || source AS folder,
                       CASE WHEN quality = 1 AND toxic = 0 THEN 'metadata.csv' WHEN quality = 1 THEN 'metadata_fr_test.csv'
                            WHEN toxic = 0 THEN 'metadata_enhanced.csv' WHEN toxic = 1 THEN 'metadata_cloned.csv'
                            ELSE 'notes.txt' END AS file
                FROM documents LEFT JOIN labels USING (doc_id))
    SELECT folder AS split, folder, arg_min(file, rank) AS file FROM listing JOIN ranks USING (file) GROUP BY folder""",
)
def q_split_discovery(spark, sf_dir):
    """The best metadata file of each folder, from a listing that the tables give."""
    labels = table(spark, sf_dir, "labels")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    file = (
        F.when(good & ~toxic, "metadata.csv")
        .when(good, "metadata_fr_test.csv")
        .when(~toxic, "metadata_enhanced.csv")
        .when(toxic, "metadata_cloned.csv")
        .otherwise("notes.txt")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("_", "lang", "source").alias("folder"))
    listing = docs.join(labels, "doc_id", "left").select(F.concat_ws("/", "folder", file).alias("path"))
    root_file = listing.limit(1).select(F.lit("metadata.csv").alias("path"))
    return discover_splits(listing.unionByName(root_file))


@query(
    """SELECT original_split AS split, count(*) AS n_rows,
              count(*) FILTER (WHERE original_split = 'dev' AND cloned_audio_fr <> '') AS n_cloned_audio_fr
       FROM utt JOIN prior USING (doc_id) GROUP BY 1""",
    ("utt", "prior"),
)
def q_publish(spark, sf_dir):
    """Splits with different columns as one partitioned dataset, and its manifest."""
    rows = utt(spark, sf_dir).drop("text").join(prior(spark, sf_dir), "doc_id")
    dev = rows.where("original_split = 'dev'").withColumn("cloned_audio_fr", F.nullif("cloned_audio_fr", F.lit("")))
    lean = rows.where("original_split = 'eval'").drop("cloned_audio_fr")
    target = new_folder(spark, "published")
    write_dataset(union_splits({"dev": dev, "eval": lean}), target)
    return dataset_manifest(spark.read.parquet(target), paths=["cloned_audio_fr"])


def _write_output_folder(spark, sf_dir, rows):
    """Two split folders, one metadata directory each, under different candidate names."""
    folder = new_folder(spark, "output")
    for split, name in (("dev", "metadata.csv"), ("eval", "metadata_cloned.csv")):
        part = rows.where(F.col("original_split") == split).drop("original_split")
        write_metadata_csv(part, f"{folder}/{split}/{name}")
    return folder


@query(
    """SELECT original_split AS split, CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text, error,
              CASE WHEN cloned_audio_fr <> '' THEN original_split || '/' || cloned_audio_fr END AS cloned_audio_fr
       FROM utt JOIN prior USING (doc_id)""",
    ("utt", "prior"),
)
def q_job_publish(spark, sf_dir):
    """Discover the splits of an output folder and publish them; paths are shown below that folder."""
    rows = utt(spark, sf_dir).select("doc_id", "original_split", "text").join(prior(spark, sf_dir).drop("toxic"), "doc_id")
    folder = _write_output_folder(spark, sf_dir, rows.withColumn("_key", F.col("doc_id")))
    target = new_folder(spark, "published")
    publish_dataset(spark, folder, target)
    back = spark.read.parquet(f"{target}/data")
    return back.withColumns({"text": F.md5("text"), "cloned_audio_fr": relative_to(F.col("cloned_audio_fr"), folder)})


@query(
    """SELECT CASE WHEN doc_id % 2 = 0 THEN 'dev' ELSE 'eval' END AS split, doc_id,
              CASE WHEN label < 9 THEN CAST(len(embedding) AS BIGINT) ELSE -1 END AS n_samples,
              CASE WHEN label < 9 THEN '' ELSE 'FileNotFoundError' END AS failure
       FROM (SELECT *, vec_id AS doc_id FROM embeddings)""",
)
def q_job_publish_audio(spark, sf_dir):
    """Publish with the audio read into the dataset; a path without a file gives null (shown as -1) and a
    reason."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    split = F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("eval")
    path = F.format_string("voices/clip_%d.wav", "doc_id")
    rows = vectors.select("doc_id", split.alias("original_split"), path.alias("voice_fr"), "label")
    folder = _write_output_folder(spark, sf_dir, rows.drop("label"))
    present = rows.where("label < 9").join(audio(spark, sf_dir), "doc_id")
    clips = present.select(F.concat_ws("/", "original_split", "voice_fr").alias("path"), "audio")
    require_written(write_audio_files(clips, folder))
    target = new_folder(spark, "published")
    publish_dataset(spark, folder, target, embed=True)
    back = spark.read.parquet(f"{target}/data")
    return back.select(
        "split",
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(sample_count(F.col("voice_fr")), F.lit(-1)).alias("n_samples"),
        F.regexp_extract("voice_fr_error", r"(\w+Error)\b", 1).alias("failure"),
    )
