"""Batch inference, composite jobs and incremental building."""

from pyspark.sql import functions as F

from speechset.constants import CLIP_COLUMNS
from speechset.functions.audio import AUDIO_TYPE
from speechset.functions.naming import resume_key
from speechset.operators.jobs import synthesize
from speechset.operators.positions import dense_positions
from speechset.operators.shape import SourceProfile
from speechset.operators.reports import run_summary
from speechset.plans.build_clips import build_clips, build_split, stored_clips
from speechset.plans.publish import publish_built
from speechset.plans.multilingual import multilingual_clips
from speechset.plans.sampled_test_set import build_test_set, sampled_test_set
from speechset.plans.voice_grid import build_grid, speaker_language_grid
from speechset.session import bounded_list, materialize, new_folder, small_table
from speechset.sinks.pieces import PIECE, pieces_of_keys, place_numbered, store_in_pieces
from speechset.streaming.history import look_up, remember
from speechset.streaming.incremental import build_arrivals, compact
from suite.fixtures import ALL_LANGS, TARGET_LANGS, audio, prior, table, utt
from suite.models import open_length_model, open_peak_encoder, open_prompt_model, open_quarter_model, open_text_model
from suite.registry import query


def _last_line(error):
    """The last line of a traceback."""
    return F.substring_index(F.rtrim(error, F.lit("\n")), "\n", -1)


@query(
    """SELECT doc_id, CASE WHEN sampling_rate = 24000 THEN CAST(length(text) AS BIGINT) ELSE -1 END AS n_samples,
              CASE WHEN sampling_rate = 24000 THEN '' ELSE 'ValueError: unsupported rate 16000' END AS error
       FROM documents JOIN audio USING (doc_id)""",
    ("audio",),
)
def q_synthesis_job(spark, sf_dir):
    """A user function on every row; its failures become errors (no samples, shown as -1) and the run goes on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clips = audio(spark, sf_dir).select("doc_id", F.col("audio.array").alias("samples"), F.col("audio.sampling_rate").alias("rate"))
    rows = docs.join(clips, "doc_id")
    made = synthesize(rows, open_length_model, ["text", "samples", "rate"], drop=["text", "samples", "rate"])
    n = F.when(F.col("out_array").isNotNull(), F.size("out_array")).otherwise(-1).cast("bigint")
    return made.select("doc_id", n.alias("n_samples"), _last_line(F.col("error")).alias("error"))


def _utterances(spark, sf_dir):
    """Utterances with French text and audio where there is any."""
    rows = utt(spark, sf_dir)
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("text")) for lang in ("en", "fr")}
    key = resume_key(F.col("original_split"), F.col("original_index"))
    ready = rows.withColumns({**texts, "_key": key}).drop("text", "lang")
    return ready.join(audio(spark, sf_dir).withColumn("audio", F.col("audio").cast(AUDIO_TYPE)), "doc_id", "left")


# Finished rows of the earlier run keep its path; of the others, audio is checked before text.
_BUILT = """
    done AS (SELECT doc_id, cloned_audio_fr AS old_path FROM prior WHERE cloned_audio_fr <> '' AND toxic = 0),
    state AS (
        SELECT u.*, old_path, CASE WHEN u.lang = 'en' THEN text ELSE '' END AS text_en,
               CASE WHEN u.lang = 'fr' THEN text ELSE '' END AS text_fr, a.sampling_rate AS rate,
               CASE WHEN old_path IS NOT NULL THEN 'done' WHEN a.doc_id IS NULL THEN 'no audio'
                    WHEN lang <> 'fr' THEN 'no text' WHEN sampling_rate = 16000 THEN 'failed' ELSE 'new' END AS outcome
        FROM utt u LEFT JOIN done USING (doc_id) LEFT JOIN audio a USING (doc_id)),
    record AS (
        SELECT original_split || ':' || original_index AS _key, speaker_id, original_split, original_index,
               md5(text_en) AS text_en, md5(text_fr) AS text_fr,
               CASE WHEN outcome IN ('failed', 'new')
                    THEN 'original_audio_en/original_' || original_split || '_' || original_index || '_en.wav' ELSE '' END AS audio_en,
               CASE outcome WHEN 'done' THEN old_path
                    WHEN 'new' THEN 'cloned_audio_fr/cloned_' || original_split || '_' || original_index || '_fr.wav'
                    ELSE '' END AS cloned_audio_fr,
               CASE outcome WHEN 'no audio' THEN 'missing or empty source audio' WHEN 'no text' THEN 'missing French text'
                    WHEN 'failed' THEN 'ValueError: unsupported rate 16000' ELSE '' END AS error
        FROM state)"""


@query(f"WITH {_BUILT} SELECT * FROM record", ("utt", "prior", "audio"))
def q_job_build_clips(spark, sf_dir):
    """Resume an earlier run: keep what is finished, check and synthesise the rest, merge the metadata."""
    rows = _utterances(spark, sf_dir)
    earlier = prior(spark, sf_dir)
    keys = rows.select("doc_id", *[c for c in CLIP_COLUMNS if c in rows.columns])
    old = keys.join(earlier, "doc_id").withColumns({"audio_en": F.lit(""), "speaker_name": F.lit("")}).select(*CLIP_COLUMNS)
    files = earlier.where("cloned_audio_fr <> '' AND toxic = 0").select("cloned_audio_fr")
    built = build_clips(rows, open_length_model, old, files)
    hashed = {"text_en": F.md5("text_en"), "text_fr": F.md5("text_fr"), "error": _last_line(F.col("error"))}
    return built.metadata.withColumns(hashed).drop("speaker_name")


@query(
    """WITH state AS (SELECT original_split, lang = 'fr' AND a.doc_id IS NOT NULL AS usable, sampling_rate = 24000 AS first
                      FROM utt LEFT JOIN audio a USING (doc_id))
       SELECT 'first' AS run, count(*) FILTER (WHERE usable AND first) AS ok,
              count(*) FILTER (WHERE NOT (usable AND coalesce(first, false))) AS errors, count(*) AS total FROM state
       UNION ALL SELECT 'second', count(*) FILTER (WHERE usable), count(*) FILTER (WHERE NOT usable), count(*) FROM state
       UNION ALL SELECT 'built again', count(*) FILTER (WHERE usable AND NOT first),
              count(*) FILTER (WHERE NOT usable), count(*) FILTER (WHERE NOT (usable AND coalesce(first, false))) FROM state
       UNION ALL SELECT 'metadata lost', count(*) FILTER (WHERE usable), count(*) FILTER (WHERE NOT usable), count(*) FROM state
       UNION ALL SELECT 'built after the loss', 0, count(*) FILTER (WHERE NOT usable), count(*) FILTER (WHERE NOT usable) FROM state
       UNION ALL SELECT 'fewer rows', count(*) FILTER (WHERE usable AND original_split = 'dev'),
              count(*) FILTER (WHERE NOT usable AND original_split = 'dev'), count(*) FILTER (WHERE original_split = 'dev') FROM state""",
    ("utt", "audio"),
)
def q_job_restart(spark, sf_dir):
    """Runs in one folder: the second model also takes the clips that the first one refused; then the
    metadata files are gone, and at last the input has only one of the splits."""
    # Stored: every run reads them.
    rows, folder = materialize(_utterances(spark, sf_dir), "utterances"), new_folder(spark, "split")

    def named(summary, run):
        return summary.select(F.lit(run).alias("run"), "ok", "errors", "total")

    first = materialize(named(build_split(rows, open_length_model, folder), "first"))
    earlier = stored_clips(spark, folder).select("run").distinct()
    second = materialize(named(build_split(rows, open_text_model, folder), "second"))
    last_run = stored_clips(spark, folder).join(earlier, "run", "left_anti")
    again = materialize(named(run_summary(last_run.withColumn("split", F.lit(""))), "built again"))

    seen = stored_clips(spark, folder).select("run").distinct()
    for export in ("csv", "json"):
        small_table(spark, [], "nothing string").write.mode("overwrite").parquet(f"{folder}/metadata.{export}")
    seen = materialize(seen)
    third = materialize(named(build_split(rows, open_text_model, folder), "metadata lost"))
    after = run_summary(stored_clips(spark, folder).join(seen, "run", "left_anti").withColumn("split", F.lit("")))
    after = materialize(named(after, "built after the loss"))
    fewer = materialize(named(build_split(rows.where("original_split = 'dev'"), open_text_model, folder), "fewer rows"))
    return first.unionByName(second).unionByName(again).unionByName(third).unionByName(after).unionByName(fewer)


@query(
    """SELECT original_split AS split, original_split || ':' || original_index AS _key, md5(CASE WHEN lang = 'fr' THEN text ELSE '' END) AS text_fr,
              CASE WHEN made THEN CAST(12000 AS BIGINT) ELSE -1 END AS half_rate, CASE WHEN made THEN CAST(length(text) AS BIGINT) ELSE -1 END AS n_samples,
              CASE WHEN made THEN CAST(0.25 * length(text) AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS sample_sum, CAST(coalesce(len("array"), -1) AS BIGINT) AS n_source,
              CASE WHEN "array" IS NULL THEN 'missing or empty source audio' WHEN NOT made THEN 'missing French text' ELSE '' END AS error
       FROM (SELECT *, lang = 'fr' AND "array" IS NOT NULL AS made FROM utt LEFT JOIN audio a USING (doc_id)
             WHERE NOT (original_split = 'dev' AND lang = 'de'))""",
    ("utt", "audio"),
)
def q_job_publish_built(spark, sf_dir):
    """Build both splits, one of them again with fewer rows, publish them with source and cloned audio, and read the
    dataset back: every row of the last inputs, failed ones with their error."""
    rows, home = _utterances(spark, sf_dir), new_folder(spark, "corpus")
    keep = (F.col("original_split") != "dev") | F.coalesce(F.col("language") != "de", F.lit(True))
    # Stored with the language: three builds and the publication read them.
    rows = materialize(rows.join(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language")), "doc_id"), "utterances")
    splits = {name: f"{home}/{name}" for name in ("dev", "eval")}
    for name, folder in splits.items():
        build_split(rows.where(F.col("original_split") == name), open_quarter_model, folder)
    build_split(rows.where((F.col("original_split") == "dev") & keep), open_quarter_model, splits["dev"])
    publish_built(spark, splits, f"{home}/published", rate=24000, sources={name: rows.where(F.col("original_split") == name) for name in splits})
    clips = spark.read.parquet(f"{home}/published/data")
    samples = F.col("cloned_audio_fr.array")
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x)
    key = F.concat_ws(":", "original_split", "original_index")
    minus = F.lit(-1).cast("bigint")
    return clips.select(
        "split", key.alias("_key"), F.md5("text_fr").alias("text_fr"),
        F.coalesce((F.col("cloned_audio_fr.sampling_rate") / 2).cast("bigint"), minus).alias("half_rate"),
        F.coalesce(F.size(samples).cast("bigint"), minus).alias("n_samples"), F.coalesce(total, F.lit(-1.0)).alias("sample_sum"),
        F.coalesce(F.size("audio_en.array").cast("bigint"), minus).alias("n_source"), "error",
    )


_PROFILE = SourceProfile(
    audio="clip",
    reference_text="body",
    texts={"fr": "text_fr", "de": "text_de", "es": "text_es"},
    speaker="source",
    row_id="doc_id",
)


def _multilingual(spark, sf_dir):
    """Every document as a reference, with its own text as translation into its own language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("text").alias("body"))
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("body")) for lang in TARGET_LANGS}
    clips = audio(spark, sf_dir).select("doc_id", F.col("audio").cast(AUDIO_TYPE).alias("clip"))
    stored = materialize(dense_positions(docs, "doc_id"), "numbered")
    numbered = stored.withColumns(texts).join(clips, "doc_id", "left")
    return multilingual_clips(numbered, _PROFILE, TARGET_LANGS, open_peak_encoder, open_prompt_model)


_CLONED = """
    langs AS (SELECT unnest(['fr', 'de', 'es']) AS target),
    marks AS (SELECT doc_id, sum(length('<|s_' || code || '|>')) AS mark_chars
              FROM (SELECT doc_id, unnest(codes) AS code FROM codes) GROUP BY 1),
    placed AS (SELECT d.*, row_number() OVER (ORDER BY d.doc_id) - 1 AS pos, sampling_rate, mark_chars
               FROM documents d LEFT JOIN audio USING (doc_id) LEFT JOIN marks USING (doc_id)),
    cloned AS (
        SELECT pos, doc_id, source, lang, target, text, mark_chars,
               CASE WHEN sampling_rate IS NULL THEN 'missing or empty source audio'
                    WHEN sampling_rate = 16000 THEN 'ValueError: unsupported rate 16000' ELSE '' END AS encoding,
               lang = target AS has_text
        FROM placed, langs),
    results AS (
        SELECT *, CASE WHEN encoding <> '' THEN encoding
                       WHEN has_text AND target = 'es' THEN 'ValueError: unsupported language es' ELSE '' END AS error,
               encoding = '' AND has_text AND target <> 'es' AS made
        FROM cloned)"""


@query(
    f"""WITH {_CLONED}
    SELECT pos, target AS lang, md5(CASE WHEN has_text THEN text ELSE '' END) AS text,
           CASE WHEN made THEN printf('cloned_audio/%s/cloned_%05d_%s.wav', target, pos, target) ELSE '' END AS path,
           CASE WHEN made THEN CAST(2 * length(text) + mark_chars + 66 AS BIGINT) ELSE -1 END AS n_samples, error
    FROM results""",
    ("audio", "codes"),
)
def q_job_multilingual(spark, sf_dir):
    """Clips of every row in three languages: the reference is encoded once, then the languages fan out."""
    clips = _multilingual(spark, sf_dir).clips
    n = F.when(F.col("clip").isNotNull(), F.size("clip.array")).otherwise(-1).cast("bigint")
    return clips.select(
        "pos", "lang", F.md5("text").alias("text"), "path", n.alias("n_samples"), _last_line(F.col("error")).alias("error")
    )


@query(
    f"""WITH {_CLONED}
    SELECT pos, CAST(doc_id AS BIGINT) AS row_id, source AS speaker_id,
           max(CASE WHEN target = 'fr' AND made THEN printf('cloned_audio/fr/cloned_%05d_fr.wav', pos) ELSE '' END) AS voice_fr,
           max(CASE WHEN target = 'de' AND made THEN printf('cloned_audio/de/cloned_%05d_de.wav', pos) ELSE '' END) AS voice_de,
           '' AS voice_es, bool_or(target = 'fr' AND made) AS voice_fr_ok, bool_or(target = 'de' AND made) AS voice_de_ok,
           false AS voice_es_ok,
           CASE WHEN any_value(encoding) = 'missing or empty source audio' THEN ''
                ELSE printf('cloned_audio/en/original_%05d.wav', pos) END AS voice_en,
           coalesce(max(error), '') AS error
    FROM results GROUP BY pos, doc_id, source""",
    ("audio", "codes"),
)
def q_job_multilingual_metadata(spark, sf_dir):
    """The same run as one wide row per input row."""
    metadata = _multilingual(spark, sf_dir).metadata
    texts = [c for c in metadata.columns if c.startswith("text_")]
    return metadata.drop("reference_text", *texts).withColumn("error", _last_line(F.col("error")))


@query(
    f"""WITH {_CLONED}
    SELECT target AS lang, count(*) FILTER (WHERE made) AS filled, count(*) AS total FROM results GROUP BY 1""",
    ("audio", "codes"),
)
def q_job_multilingual_coverage(spark, sf_dir):
    return _multilingual(spark, sf_dir).coverage


@query(
    """WITH picked AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) - 1 AS selected_id FROM documents)
       SELECT selected_id, CAST(doc_id AS VARCHAR) AS original_index, md5(CASE WHEN lang = 'en' THEN text ELSE '' END) AS source_text_en,
              md5(CASE WHEN lang = 'fr' THEN text ELSE '' END) AS text_fr,
              CASE WHEN lang = 'fr' THEN printf('cloned_audio_fr_test/cloned_%05d_fr.wav', selected_id) ELSE '' END AS cloned_voice_fr,
              CASE WHEN lang = 'fr' THEN CAST(length(text) AS BIGINT) ELSE 0 END AS cloned_length_fr, '' AS error
       FROM picked WHERE selected_id < 100""",
)
def q_job_sampled_test_set(spark, sf_dir):
    """A seeded sample of a hundred rows over all splits, with a clip each."""
    docs = table(spark, sf_dir, "documents")
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("text")) for lang in ("en", "fr")}
    rows = docs.withColumns({**texts, "original_index": F.col("doc_id").cast("string")}).drop("text")
    made = sampled_test_set(rows, open_text_model, key="doc_id")
    return made.drop("clip").withColumns({"source_text_en": F.md5("source_text_en"), "text_fr": F.md5("text_fr")})


@query(
    """WITH ten AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS sample_index, text FROM documents
                    QUALIFY sample_index < 10)
       SELECT r_name AS speaker, lang AS language,
              CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE 'Spanish' END AS language_name,
              md5(text) AS text, printf('audio/%s/%s_%s_%05d.wav', lang, lower(r_name), lang, sample_index) AS audio_path,
              CAST(length(text) AS BIGINT) AS audio_length_samples, sample_index, '' AS error
       FROM ten CROSS JOIN region""",
)
def q_job_grid(spark, sf_dir):
    """The synthetic set: five voices say ten sentences of four languages."""
    docs = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").alias("sample_index"), "text")
    voices = bounded_list(table(spark, sf_dir, "region"), "r_name")
    grid = speaker_language_grid(docs, ALL_LANGS, open_text_model, voices, known_voices=voices)
    return grid.drop("clip").withColumn("text", F.md5("text"))


@query(
    """SELECT 'run 1' AS step, count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys FROM utt WHERE original_split = 'dev'
       UNION ALL SELECT 'run 2', count(*), count(DISTINCT doc_id) FROM utt WHERE original_split = 'dev'
       UNION ALL SELECT 'run 3', count(*), count(DISTINCT doc_id) FROM utt
       UNION ALL SELECT 'final', count(*), count(DISTINCT doc_id) FROM utt
       UNION ALL SELECT 'failed batches', 0, 0""",
    ("utt",),
)
def q_incremental(spark, sf_dir):
    """Three runs over a folder: dev arrives, nothing arrives, eval arrives together with dev again."""
    arrivals, output = new_folder(spark, "arrivals"), new_folder(spark, "built")
    checkpoint = new_folder(spark, "stream-checkpoint")
    rows = utt(spark, sf_dir).select("doc_id", "original_split", "text")
    schema = "doc_id bigint, original_split string, text string"

    def run():
        build_arrivals(
            spark, arrivals, schema, output, checkpoint,
            build=lambda batch: batch.select("doc_id", F.length("text").alias("n_chars")),
            key="doc_id", files_per_batch=1000, publish=lambda built, batch_id: built.count(),
        )

    def state(step):
        sizes = spark.read.parquet(output).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_keys"))
        row = sizes.first()
        return (step, row.n_rows, row.n_keys)

    rows.where("original_split = 'dev'").write.mode("append").parquet(arrivals)
    run()
    states = [state("run 1")]
    run()
    states.append(state("run 2"))
    rows.write.mode("append").parquet(arrivals)
    run()
    states.append(state("run 3"))
    final = compact(spark, output, new_folder(spark, "final"), "doc_id")
    failed = spark.read.json(f"{output}_publish_log").where("report <> 'published'")
    totals = [("final", final, "doc_id"), ("failed batches", failed, "batch_id")]
    report = small_table(spark, states, "step string, n_rows bigint, n_keys bigint")
    for step, df, key in totals:
        sizes = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"))
        report = report.unionByName(sizes.select(F.lit(step).alias("step"), "n_rows", "n_keys"))
    return report


@query(
    """WITH d AS (SELECT doc_id % 4 AS batch, doc_id FROM documents UNION ALL SELECT 3, doc_id FROM documents WHERE doc_id % 4 = 1 AND lang = 'de')
       SELECT batch, count(*) AS n_arrived, count(*) FILTER (doc_id % 4 = batch) AS n_built,
              CASE WHEN batch = 3 THEN (SELECT count(*) FROM documents WHERE doc_id % 4 = 1) ELSE 0 END AS keys_read FROM d GROUP BY batch""",
)
def q_incremental_pruned(spark, sf_dir):
    """Four batches, the last with some rows of the second again: what arrives, what is built, and how many keys of the history
    are read for it. New rows read none, however many batches there were."""
    index = new_folder(spark, "history")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "lang")
    report = []
    for batch in range(4):
        rows = docs.where(F.col("key") % 4 == batch)
        if batch == 3:
            rows = rows.unionByName(docs.where((F.col("key") % 4 == 1) & (F.col("lang") == "de")))
        finished, read = look_up(rows.select("key"), index, batch)
        todo = materialize(rows.select("key").join(finished, rows["key"].cast("string") == finished["key"], "left_anti"), "todo")
        report.append((batch, rows.count(), todo.count(), read.count()))
        remember(todo, index, batch)
    return small_table(spark, report, "batch bigint, n_arrived bigint, n_built bigint, keys_read bigint")


def open_no_model():
    """Refuses every call: a job that has its results asks nothing."""

    def refuse(*args):
        raise RuntimeError("a model was called")

    return refuse


@query(
    """WITH picked AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) - 1 AS selected_id FROM documents),
            made AS (SELECT *, lang = 'fr' AS fr FROM picked WHERE selected_id < 100)
       SELECT 'test set' AS job, CAST(selected_id AS VARCHAR) AS name, 'clip_' || doc_id || '.wav' AS source,
              CASE WHEN fr THEN printf('cloned_audio_fr_test/cloned_%05d_fr.wav', selected_id) ELSE '' END AS path,
              CASE WHEN fr THEN CAST(length(text) AS BIGINT) ELSE 0 END AS n_samples, '' AS error FROM made
       UNION ALL
       SELECT 'grid', r_name || ' ' || lang || ' ' || sample_index, '', printf('audio/%s/%s_%s_%05d.wav', lang, lower(r_name), lang, sample_index),
              CAST(length(text) AS BIGINT), ''
       FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS sample_index, text FROM documents QUALIFY sample_index < 10)
       CROSS JOIN region
       UNION ALL SELECT 'warning', 'no texts available for language vi', '', '', 0, ''""",
)
def q_job_stored(spark, sf_dir):
    """The sampled test set and the grid, stored; both are asked for again with a model that refuses every call, and come from
    their folders. A language without sentences is a warning."""
    home, docs = new_folder(spark, "stored"), table(spark, sf_dir, "documents")
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("text")) for lang in ("en", "fr")}
    audio_from = F.struct(F.concat(F.lit("clip_"), "doc_id", F.lit(".wav")).alias("path"))
    rows = docs.withColumns({**texts, "original_index": F.col("doc_id").cast("string"), "audio": audio_from}).drop("text")
    catalogue = docs.select("lang", F.col("doc_id").alias("sample_index"), "text")
    voices = bounded_list(table(spark, sf_dir, "region"), "r_name")
    for model in (open_text_model, open_no_model):
        sample = build_test_set(rows, model, f"{home}/sample", key="doc_id")
        grid = build_grid(catalogue, [*ALL_LANGS, "vi"], model, f"{home}/grid", voices, known_voices=voices)
    read = spark.read.json(f"{home}/sample/metadata_fr_test.json")
    sizes = sample.select("selected_id", F.coalesce(F.size("clip.array"), F.lit(0)).cast("bigint").alias("n_samples"))
    first = read.join(sizes, "selected_id").select(
        F.lit("test set").alias("job"), F.col("selected_id").cast("string").alias("name"), F.col("source_audio_path").alias("source"),
        F.col("cloned_voice_fr").alias("path"), "n_samples", "error",
    )
    name = F.concat_ws(" ", "speaker", "language", "sample_index")
    second = grid.select(
        F.lit("grid").alias("job"), name.alias("name"), F.lit("").alias("source"), F.col("audio_path").alias("path"),
        F.size("clip.array").cast("bigint").alias("n_samples"), "error",
    )
    warned = spark.read.json(f"{home}/grid/warnings/grid").select(
        F.lit("warning").alias("job"), F.col("message").alias("name"), F.lit("").alias("source"), F.lit("").alias("path"),
        F.lit(0).cast("bigint").alias("n_samples"), F.lit("").alias("error"),
    )
    return first.unionByName(second).unionByName(warned)


# Prompts over so many characters are guarded in the query below.
_GUARD = 5000


@query(
    f"""WITH {_CLONED}
    SELECT pos, target AS lang, made AND 2 * length(text) + mark_chars + 66 > {_GUARD} AS trimmed, made AS ok,
           CASE WHEN made THEN CAST(2 * length(text) + mark_chars + 66 AS BIGINT) ELSE -1 END AS n_samples,
           CASE WHEN encoding = 'missing or empty source audio' OR error = '' THEN error ELSE 'tried again' END AS error
    FROM results""",
    ("audio", "codes"),
)
def q_job_multilingual_again(spark, sf_dir):
    """The multilingual job with its folder and the prompt guard, asked for twice: the second time the encoder and the model
    refuse every call, and only what failed is tried again. Long prompts are marked; the clips here are shorter than the three
    seconds that a guarded reference keeps."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("text").alias("body"))
    texts = {f"text_{lang}": F.when(F.col("lang") == lang, F.col("body")) for lang in TARGET_LANGS}
    clips = audio(spark, sf_dir).select("doc_id", F.col("audio").cast(AUDIO_TYPE).alias("clip"))
    # Only keys are numbered; texts and clips are shuffled once, to the pieces in which they stay.
    keys = materialize(dense_positions(docs.select("doc_id"), "doc_id"), "numbered")
    pieces, by_key = pieces_of_keys(keys, "doc_id")
    rows = place_numbered(docs, keys, "doc_id", by_key).join(by_key.place(clips, "doc_id"), [PIECE, "doc_id"], "left")
    numbered = store_in_pieces(rows.withColumns(texts), new_folder(spark, "rows"), pieces)
    home = new_folder(spark, "multilingual")
    for encoder, model in ((open_peak_encoder, open_prompt_model), (open_no_model, open_no_model)):
        job = multilingual_clips(
            numbered, _PROFILE, TARGET_LANGS, encoder, model, folder=home, shared=["en", "de", "fr"], count_tokens=F.length, token_limit=_GUARD,
            pieces=pieces,
        )
    assert spark.read.json(f"{home}/warnings/multilingual").count() == 1
    n = F.when(F.col("clip").isNotNull(), F.size("clip.array")).otherwise(-1).cast("bigint")
    error = F.when(F.col("error").contains("a model was called"), F.lit("tried again")).otherwise(_last_line(F.col("error")))
    return job.clips.select("pos", "lang", "trimmed", (F.col("path") != "").alias("ok"), n.alias("n_samples"), error.alias("error"))
