"""Audio and token columns."""

from pyspark.sql import functions as F

from speechset.functions.audio import (
    clip_seconds,
    declare_audio,
    extract_audio,
    has_samples,
    pad_missing,
    resample_audio,
    resampled_length,
    sample_count,
)
from speechset.functions.tokens import clone_prompt, count_codes, format_codes, guard_reference, parse_codes
from suite.fixtures import audio, codes, table
from suite.registry import query


def _documents_with_audio(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(audio(spark, sf_dir), "doc_id", "left")


@query(
    """WITH found AS (SELECT doc_id, coalesce(CAST(len("array") AS BIGINT), -1) AS n_samples, coalesce(sampling_rate, -1) AS sampling_rate
                      FROM documents LEFT JOIN audio USING (doc_id))
       SELECT 'struct' AS layout, * FROM found
       UNION ALL SELECT 'columns', * FROM found
       UNION ALL SELECT 'absent', doc_id, -1, -1 FROM documents""",
    ("audio",),
)
def q_audio_extract(spark, sf_dir):
    """One audio value from a struct column, from two columns, and from neither. Nulls are shown as -1."""
    nested = _documents_with_audio(spark, sf_dir)
    flat = nested.select("doc_id", F.col("audio.array").alias("samples"), F.col("audio.sampling_rate").alias("rate"))

    def report(df, layout, value):
        one = df.select("doc_id", value.alias("value"))
        return one.select(
            F.lit(layout).alias("layout"),
            "doc_id",
            F.coalesce(sample_count(F.col("value")), F.lit(-1)).alias("n_samples"),
            F.coalesce(F.col("value.sampling_rate"), F.lit(-1)).alias("sampling_rate"),
        )

    parts = [
        report(nested, "struct", extract_audio(nested)),
        report(flat, "columns", extract_audio(flat, "samples", "rate")),
        report(flat.select("doc_id"), "absent", extract_audio(flat.select("doc_id"))),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT doc_id, CAST(coalesce(len("array"), 1) AS BIGINT) AS n_samples, coalesce(sampling_rate, 24000) AS sampling_rate,
              "array" IS NOT NULL AS voice_ok FROM documents LEFT JOIN audio USING (doc_id)""",
    ("audio",),
)
def q_audio_pad(spark, sf_dir):
    """Missing clips become one zero sample, and a flag tells them apart."""
    rows = _documents_with_audio(spark, sf_dir).withColumn("voice_ok", has_samples(F.col("audio")))
    padded = declare_audio(rows.withColumn("audio", pad_missing(F.col("audio"))), "audio", 24000)
    return padded.select("doc_id", sample_count(F.col("audio")).alias("n_samples"), "audio.sampling_rate", "voice_ok")


@query(
    """SELECT doc_id, CAST(len("array") AS BIGINT) AS n_samples, round(len("array") / sampling_rate, 6) AS seconds FROM audio""",
    ("audio",),
)
def q_audio_duration(spark, sf_dir):
    clip = F.col("audio")
    return audio(spark, sf_dir).select(
        "doc_id", sample_count(clip).alias("n_samples"), F.round(clip_seconds(clip), 6).alias("seconds")
    )


# The filter from 24 to 16 kHz: two output samples for three input ones, 96 taps. Sums of samples are compared as they are
# stored, in single precision.
@query(
    """WITH x AS (SELECT doc_id, sampling_rate, unnest("array") AS x, unnest(range(len("array"))) AS p FROM audio WHERE sampling_rate = 24000),
            i AS (SELECT doc_id, unnest(range(CAST(ceil(len("array") * 2 / 3) AS BIGINT))) AS i FROM audio WHERE sampling_rate = 24000),
            k AS (SELECT phase, k, k - phase / 2 AS t FROM range(2) AS a(phase), range(-47, 49) AS b(k)),
            w AS (SELECT phase, k, 2.0::DOUBLE / 3 * CASE WHEN t = 0 THEN 1 ELSE sin(pi() * 2 / 3 * t) / (pi() * 2 / 3 * t) END * (0.5 + 0.5 * cos(pi() * t / 48)) AS w FROM k),
            taps AS (SELECT phase, k, w / sum(w) OVER (PARTITION BY phase) AS w FROM w),
            y AS (SELECT i.doc_id, i, CAST(sum(CAST(x AS DOUBLE) * w) AS FLOAT) AS y FROM i JOIN taps ON phase = i % 2
                  JOIN x ON x.doc_id = i.doc_id AND p = i * 3 // 2 + k GROUP BY i.doc_id, i)
       SELECT doc_id, CAST(ceil(len("array") * 16000 / sampling_rate) AS BIGINT) AS n_samples, 16000 AS sampling_rate,
              round(CASE WHEN sampling_rate = 16000 THEN list_sum(list_transform("array", lambda v: CAST(v AS DOUBLE)))
                         ELSE (SELECT sum(CAST(y AS DOUBLE)) FROM y WHERE y.doc_id = audio.doc_id) END, 6) AS sample_sum,
              round(CASE WHEN sampling_rate = 16000 THEN list_sum(list_transform("array", lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))
                         ELSE (SELECT sum(CAST(y AS DOUBLE) * CAST(y AS DOUBLE)) FROM y WHERE y.doc_id = audio.doc_id) END, 6) AS power
       FROM audio""",
    ("audio",),
)
def q_resample(spark, sf_dir):
    """Clips at 16 kHz; those that are already there are left alone."""
    clip = F.col("audio")
    done = audio(spark, sf_dir).select("doc_id", resample_audio(clip, 16000).alias("out"))
    total = F.aggregate("out.array", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double"))
    power = F.aggregate("out.array", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v.cast("double"))
    return done.select(
        "doc_id", sample_count(F.col("out")).alias("n_samples"), "out.sampling_rate",
        F.round(total, 6).alias("sample_sum"), F.round(power, 6).alias("power"),
    )


_MARKS = "list_reduce(list_prepend('', list_transform({}, lambda c: '<|s_' || c || '|>')), lambda a, b: a || b)"


@query(f"SELECT vec_id, {_MARKS.format('codes')} AS tokens FROM codes", ("codes",))
def q_token_format(spark, sf_dir):
    return codes(spark, sf_dir).select("vec_id", format_codes(F.col("codes")).alias("tokens"))


@query(
    """SELECT vec_id, CASE WHEN label >= 5 THEN array_to_string(list_reverse(codes), ',') END AS strict_codes,
              array_to_string(list_reverse(codes), ',') AS lenient_codes, CAST(2 * len(codes) AS BIGINT) AS n_marks
       FROM codes""",
    ("codes",),
)
def q_token_parse(spark, sf_dir):
    """Codes of the last speech section; without any section marker only the lenient form finds them."""
    rows = codes(spark, sf_dir)
    answer = format_codes(F.reverse("codes"))
    prompt = clone_prompt(F.lit("ref"), format_codes(F.col("codes")), F.lit("target"))
    bare = F.concat(F.lit("no section "), answer)
    generated = F.when(F.col("label") >= 5, F.concat(prompt, answer)).otherwise(bare)
    marks = count_codes(F.concat(format_codes(F.col("codes")), answer))
    return rows.select(
        "vec_id",
        F.array_join(parse_codes(generated), ",").alias("strict_codes"),
        F.array_join(parse_codes(generated, strict=False), ",").alias("lenient_codes"),
        marks.alias("n_marks"),
    )


@query(
    f"""SELECT doc_id, md5('<|im_start|>' || text || '<|speech_start|>' || {_MARKS.format('codes')} || '<|im_end|><|im_start|>'
               || source || ': ' || text || '<|speech_start|>') AS prompt
        FROM documents JOIN codes USING (doc_id)""",
    ("codes",),
)
def q_prompt(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws(": ", "source", "text").alias("target"))
    rows = docs.join(codes(spark, sf_dir), "doc_id")
    prompt = clone_prompt(F.col("text"), format_codes(F.col("codes")), F.col("target"))
    return rows.select("doc_id", F.md5(prompt).alias("prompt"))


@query(
    """SELECT doc_id, CAST(CASE WHEN len("array") + length(text) - length(replace(text, ' ', '')) > 300
                                THEN least(len("array"), 48) ELSE len("array") END AS BIGINT) AS kept,
              CAST(CASE WHEN len("array") + length(text) - length(replace(text, ' ', '')) > 300
                        THEN least(len("array"), sampling_rate // 1000) ELSE len("array") END AS BIGINT) AS kept_by_rate
       FROM documents JOIN audio USING (doc_id)""",
    ("audio",),
)
def q_prompt_guard(spark, sf_dir):
    """Prompts beyond a token limit are rebuilt from the head of the reference clip."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.join(audio(spark, sf_dir), "doc_id")
    array, text = F.col("audio.array"), F.col("text")
    tokens = F.size(array) + F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    by_rate = (F.col("audio.sampling_rate") / 1000).cast("int")
    return rows.select(
        "doc_id",
        F.size(guard_reference(array, tokens, limit=300, cap=48)).cast("bigint").alias("kept"),
        F.size(guard_reference(array, tokens, limit=300, cap=by_rate)).cast("bigint").alias("kept_by_rate"),
    )
