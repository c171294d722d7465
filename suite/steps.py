"""Committed steps and co-located resume."""

from pyspark.sql import functions as F

from speechset.operators.balance import deal_by_cost
from speechset.operators.jobs import synthesize
from speechset.operators.positions import large_sample
from speechset.operators.resume import pending_rows
from speechset.plans.build_steps import build_in_steps, step_commits, store_utterances
from speechset.plans.publish_versions import current_version, publish_version, read_published, version_manifest
from speechset.session import materialize, new_folder
from speechset.sinks.bucketed import read_bucketed, store_bucketed
from suite.fixtures import audio, prior, table
from suite.jobs import _utterances
from suite.models import open_length_model
from suite.registry import query


@query(
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, coalesce(len("array"), 0) AS n_samples
       FROM documents LEFT JOIN audio USING (doc_id)
       WHERE doc_id NOT IN (SELECT doc_id FROM prior WHERE cloned_audio_fr <> '')""",
    ("audio", "prior"),
)
def q_resume_bucketed(spark, sf_dir):
    """What a restart has to do, with its texts and audio: both sides are stored in buckets of the key."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").join(audio(spark, sf_dir), "doc_id", "left")
    folder = new_folder(spark, "bucketed")
    utterances = store_bucketed(rows, f"{folder}/utterances", "doc_id", 8)
    finished = store_bucketed(prior(spark, sf_dir).where("cloned_audio_fr <> ''").select("doc_id"), f"{folder}/finished", "doc_id", 8)
    left = pending_rows(utterances, finished.hint("shuffle_hash"), "doc_id")
    n_samples = F.coalesce(F.array_size("audio.array"), F.lit(0)).cast("bigint")
    return left.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), n_samples.alias("n_samples"))


class Stop(BaseException):
    """A run that is killed."""


# The first run is stopped after two steps; failed rows of these are tried again by the second one.
STEPS_BEFORE_STOP = 2


@query(
    f"""WITH u AS (SELECT *, original_split || ':' || original_index AS k, count(*) OVER () AS c,
                          lang = 'fr' AND sampling_rate = 24000 AS good FROM utt LEFT JOIN audio USING (doc_id)),
             s AS (SELECT k, coalesce(good, false) AS good,
                          CAST('0x' || substr(md5(k), 1, 8) AS BIGINT) % CAST(ceil(c / (c // 5)) AS BIGINT) AS step FROM u),
             n AS (SELECT step, count(*) AS n_rows, count(*) FILTER (good) AS n_good, row_number() OVER (ORDER BY step) AS nth FROM s GROUP BY step)
        SELECT CAST(step AS INTEGER) AS step, CAST(1 AS BIGINT) AS run, n_rows, n_good AS ok FROM n WHERE nth <= {STEPS_BEFORE_STOP}
        UNION ALL SELECT CAST(step AS INTEGER), 2, n_rows - n_good, 0 FROM n WHERE nth <= {STEPS_BEFORE_STOP} AND n_rows > n_good
        UNION ALL SELECT CAST(step AS INTEGER), 2, n_rows, n_good FROM n WHERE nth > {STEPS_BEFORE_STOP}""",
    ("utt", "audio"),
)
def q_job_build_steps(spark, sf_dir):
    """Rows that each run built in each step, and how many of them are finished: the first run is stopped
    between two steps, the second one goes on."""
    home = new_folder(spark, "steps")
    rows = materialize(_utterances(spark, sf_dir), "utterances")
    n = rows.count()
    store_utterances(rows, f"{home}/corpus", step_rows=n // 5)
    done = []

    def stop(step):
        done.append(step)
        if len(done) == STEPS_BEFORE_STOP:
            raise Stop

    try:
        build_in_steps(spark, f"{home}/corpus", open_length_model, f"{home}/split", publish=stop)
    except Stop:
        pass
    build_in_steps(spark, f"{home}/corpus", open_length_model, f"{home}/split")
    clips = read_bucketed(spark, f"{home}/split/clips")
    built = clips.groupBy("run", F.col("_step").alias("step")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("cloned_audio_fr") != "").alias("ok")
    )
    runs = built.select("run").distinct().orderBy("run").limit(10).collect()  # two
    first = runs[0]["run"]
    assert step_commits(spark, f"{home}/split").count() == built.count()
    return built.withColumn("run", F.when(F.col("run") == first, 1).otherwise(2).cast("bigint"))


_BUCKETS = 5


@query(
    f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'dev' ELSE 'eval' END AS split, text, lang, "array" IS NOT NULL AS has_audio,
                          CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % {_BUCKETS} AS bucket, coalesce(toxic, 0) AS toxic
                   FROM documents LEFT JOIN audio USING (doc_id) LEFT JOIN labels USING (doc_id)),
             v AS (SELECT 1 AS v, * EXCLUDE (text), text FROM d WHERE split = 'dev'
                   UNION ALL SELECT 2, * EXCLUDE (text), text FROM d
                   UNION ALL SELECT 3, * EXCLUDE (text), CASE WHEN toxic = 1 THEN text || '!' ELSE text END FROM d WHERE split = 'dev' AND lang <> 'fr'
                   UNION ALL SELECT 3, * EXCLUDE (text), text FROM d WHERE split = 'eval'),
             b AS (SELECT v, split, bucket, list([CAST(doc_id AS VARCHAR), text] ORDER BY doc_id) AS content FROM v GROUP BY v, split, bucket),
             w AS (SELECT n.v, n.split, count(*) AS n_written FROM b n LEFT JOIN b o ON o.v = n.v - 1 AND o.split = n.split AND o.bucket = n.bucket
                   WHERE o.content IS DISTINCT FROM n.content GROUP BY n.v, n.split),
             s AS (SELECT v, split, count(*) AS n_rows, count(*) FILTER (has_audio) AS n_audio, CAST(sum(length(text)) AS BIGINT) AS n_chars,
                          bit_xor(CAST('0x' || substr(md5(text), 1, 8) AS BIGINT)) AS digest FROM v GROUP BY v, split),
             r AS (SELECT * FROM (VALUES ('dev', 1), ('all', 2), ('after a failure', 2), ('changed', 3)) AS x(step, v))
        SELECT step, split, n_rows, n_audio, n_chars, digest, CASE WHEN step = 'after a failure' THEN 0 ELSE coalesce(n_written, 0) END AS n_written
        FROM r JOIN s USING (v) LEFT JOIN w USING (v, split)""",
    ("audio",),
)
def q_publish_versions(spark, sf_dir):
    """Four publications, and what a reader sees after each: one split, then the other one, then a publication that fails
    half way, then the same with other texts and fewer rows. Only buckets that changed are written."""
    target = new_folder(spark, "published")
    docs = table(spark, sf_dir, "documents").join(audio(spark, sf_dir), "doc_id", "left").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    docs = docs.withColumn("split", F.when(F.col("doc_id") % 2 == 0, "dev").otherwise("eval"))
    # Stored: every publication reads it twice.
    docs = materialize(docs.select("split", F.col("doc_id").alias("_id"), "lang", "toxic", "text", "audio"), "utterances")
    dev, evaluation = docs.where("split = 'dev'"), docs.where("split = 'eval'")
    louder = F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    changed = dev.where("lang <> 'fr'").withColumn("text", louder)
    # The sizes of this one can be counted, but its last rows cannot be written.
    broken = changed.withColumn("audio", F.when(F.col("_id") > 0, F.raise_error(F.lit("a broken clip")).cast(audio(spark, sf_dir).schema["audio"].dataType)))
    seen = []
    for step, dataset in (("dev", dev), ("all", evaluation), ("after a failure", broken), ("changed", changed)):
        before = current_version(spark, target)
        try:
            publish_version(dataset, target, "_id", buckets=_BUCKETS)
        except Exception as failure:
            assert step == "after a failure", failure
        version = current_version(spark, target)
        written = version_manifest(spark, target, version).where((F.col("v") == version) & F.lit(version != before))
        written = written.groupBy("split").agg(F.count(F.lit(1)).alias("n_written"))
        rows = read_published(spark, target)
        part = F.conv(F.substr(F.md5("text"), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
        sizes = rows.groupBy("split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("audio").alias("n_audio"), F.sum(F.length("text")).alias("n_chars"), F.bit_xor(part).alias("digest")
        )
        joined = sizes.join(written, "split", "left").fillna(0, ["n_written"])
        seen.append(materialize(joined.select(F.lit(step).alias("step"), "split", "n_rows", "n_audio", "n_chars", "digest", "n_written"), "seen"))
    assert spark.read.json(f"{target}/failures").count() == 1
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3])


@query(
    """SELECT doc_id, CASE WHEN sampling_rate = 24000 THEN CAST(length(text) AS BIGINT) ELSE -1 END AS n_samples,
              CASE WHEN sampling_rate = 24000 THEN '' ELSE 'ValueError: unsupported rate 16000' END AS error, true AS even
       FROM documents JOIN audio USING (doc_id)""",
    ("audio",),
)
def q_job_balanced(spark, sf_dir):
    """A user function on every row, with the work dealt by length of text: no task has a fifth more than another."""
    tasks = 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clips = audio(spark, sf_dir).select("doc_id", F.col("audio.array").alias("samples"), F.col("audio.sampling_rate").alias("rate"))
    dealt = deal_by_cost(docs.join(clips, "doc_id"), F.length("text"), tasks, "doc_id")
    made = synthesize(dealt.withColumn("task", F.spark_partition_id()), open_length_model, ["text", "samples", "rate"], drop=["samples", "rate"])
    made = materialize(made.withColumn("n_chars", F.length("text")).drop("text"), "made")
    load = made.groupBy("task").agg(F.sum("n_chars").alias("cost")).agg(F.count(F.lit(1)), F.min("cost"), F.max("cost")).first()
    n = F.when(F.col("out_array").isNotNull(), F.size("out_array")).otherwise(-1).cast("bigint")
    even = F.lit(load[0] == tasks and load[2] <= 1.2 * load[1])
    return made.select("doc_id", n.alias("n_samples"), F.substring_index(F.rtrim("error", F.lit("\n")), "\n", -1).alias("error"), even.alias("even"))


@query(
    """WITH n AS (SELECT count(*) // 2 AS half FROM documents)
       SELECT doc_id, selected_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('5:' || doc_id), doc_id) - 1 AS selected_id FROM documents), n
       WHERE selected_id < half""",
)
def q_seeded_share(spark, sf_dir):
    """Half of all documents, as a sample of any size is drawn: by a digest bound, and numbered in pieces."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return large_sample(docs, docs.count() // 2, "doc_id", seed=5)
