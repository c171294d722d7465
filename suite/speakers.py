"""Positions, speakers, splits and samples."""

from pyspark.sql import functions as F

from speechset.constants import SPEAKER_RANGES
from speechset.operators.positions import concat_in_order, dense_positions, first_per_group, first_rows, seeded_sample
from speechset.operators.reports import distinct_set, distinct_values, split_counts
from speechset.operators.speakers import (
    annotate_speakers,
    smallest_speakers,
    speaker_sizes,
    test_rows,
    train_rows,
)
from speechset.plans.speaker_split import annotate_corpus, check_speaker_split, speaker_split, speaker_split_report
from suite.fixtures import table, utt
from suite.registry import query

_BOTTOM = """
    sizes AS (SELECT speaker_id, count(*) AS n FROM utt GROUP BY 1),
    bottom AS (SELECT speaker_id, n FROM sizes ORDER BY n, speaker_id LIMIT 2)"""

_RANGES = ",\n".join(f"('{s}', {lo}, {hi}, {num}, '{name}')" for s, lo, hi, num, name in SPEAKER_RANGES)

_ANNOTATED = f"""
    ranges AS (SELECT * FROM (VALUES {_RANGES}) AS r(split, lo, hi, num, name)),
    placed AS (SELECT doc_id, lang, original_split,
                      row_number() OVER (PARTITION BY original_split ORDER BY doc_id) - 1 AS pos FROM utt),
    annotated AS (
        SELECT doc_id, original_split, pos,
               CASE WHEN num IS NULL THEN 'speaker_unknown' ELSE printf('speaker_%02d', num) END AS speaker_id,
               coalesce(name, 'Unknown') AS speaker_name, original_split || ':' || pos AS _key
        FROM placed LEFT JOIN ranges ON split = original_split AND pos BETWEEN lo AND hi)"""


@query(
    f"WITH {_BOTTOM} SELECT CASE WHEN speaker_id IN (SELECT speaker_id FROM bottom) THEN 'test' ELSE 'train' END"
    " AS split, speaker_id, n FROM sizes",
    ("utt",),
)
def q_split_speaker_disjoint(spark, sf_dir):
    """Rows per speaker after the speaker-disjoint split."""
    return speaker_split_report(utt(spark, sf_dir))


@query(
    f"WITH {_BOTTOM} SELECT doc_id, CASE WHEN speaker_id IN (SELECT speaker_id FROM bottom) THEN 'test'"
    " ELSE 'train' END AS split FROM utt",
    ("utt",),
)
def q_split_rows(spark, sf_dir):
    """The split of every row."""
    return speaker_split(utt(spark, sf_dir)).select("doc_id", "split")


@query(
    f"""WITH {_BOTTOM}
    SELECT doc_id, 'test' AS split FROM utt WHERE speaker_id IN (SELECT speaker_id FROM bottom)
    UNION ALL SELECT doc_id, 'train' FROM utt WHERE speaker_id NOT IN (SELECT speaker_id FROM bottom)""",
    ("utt",),
)
def q_split_filters(spark, sf_dir):
    """The two sides of the split as two filtered tables."""
    rows = utt(spark, sf_dir).select("doc_id", "speaker_id")
    chosen = smallest_speakers(speaker_sizes(rows), 2)
    test = test_rows(rows, chosen, 2).select("doc_id", F.lit("test").alias("split"))
    train = train_rows(rows, chosen, 2).select("doc_id", F.lit("train").alias("split"))
    return test.unionByName(train)


@query("SELECT speaker_id, count(*) AS n FROM utt GROUP BY 1", ("utt",))
def q_speaker_sizes(spark, sf_dir):
    return speaker_sizes(utt(spark, sf_dir))


@query(f"WITH {_BOTTOM} SELECT speaker_id, n FROM bottom", ("utt",))
def q_bottom_speakers(spark, sf_dir):
    return smallest_speakers(speaker_sizes(utt(spark, sf_dir)), 2)


@query(
    "SELECT source AS speaker_id, count(*) AS n FROM documents GROUP BY 1 ORDER BY n, speaker_id LIMIT 3",
)
def q_bottom_speakers_tied(spark, sf_dir):
    """Sources as speakers have equal sizes: ties go to the smaller id."""
    sizes = speaker_sizes(table(spark, sf_dir, "documents").withColumnRenamed("source", "speaker_id"))
    return smallest_speakers(sizes, 3)


@query("SELECT original_split, count(*) AS n FROM utt GROUP BY ROLLUP (original_split)", ("utt",))
def q_split_counts(spark, sf_dir):
    return split_counts(utt(spark, sf_dir), "original_split")


@query(
    f"""WITH {_BOTTOM},
    labelled AS (SELECT speaker_id, CASE WHEN speaker_id IN (SELECT speaker_id FROM bottom) THEN 'test' ELSE 'train' END
                 AS split FROM utt),
    per_speaker AS (SELECT speaker_id, count(*) FILTER (WHERE split = 'test') AS t,
                    count(*) FILTER (WHERE split = 'train') AS r FROM labelled GROUP BY 1)
    SELECT count(*) FILTER (WHERE t > 0 AND r > 0) AS shared_speakers,
           bool_and(t > 0 AND r = 0) FILTER (WHERE speaker_id IN (SELECT speaker_id FROM bottom)) AS expected_only_in_test,
           CAST(sum(t) AS BIGINT) AS test_rows, CAST(sum(r) AS BIGINT) AS train_rows,
           sum(t) + sum(r) = (SELECT count(*) FROM documents) AS complete
    FROM per_speaker""",
    ("utt",),
)
def q_split_verify(spark, sf_dir):
    return check_speaker_split(utt(spark, sf_dir))


@query(
    """SELECT original_split, original_split || ':' || original_index AS _key,
              row_number() OVER (PARTITION BY original_split ORDER BY original_index) - 1 AS pos
       FROM utt QUALIFY row_number() OVER (PARTITION BY original_split ORDER BY original_index) <= 3""",
    ("utt",),
)
def q_split_first_keys(spark, sf_dir):
    keyed = utt(spark, sf_dir).select(
        "original_split", "original_index", F.concat_ws(":", "original_split", F.col("original_index")).alias("_key")
    )
    return first_per_group(keyed, 3, ["original_split"], "original_index").select("original_split", "_key", "pos")


@query(
    "SELECT original_split, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages FROM utt GROUP BY 1", ("utt",)
)
def q_distinct_sets(spark, sf_dir):
    sets = distinct_set(utt(spark, sf_dir), "lang", ["original_split"], "languages")
    return sets.withColumn("languages", F.array_join("languages", ","))


@query("SELECT DISTINCT original_split, speaker_id FROM utt", ("utt",))
def q_distinct_speakers(spark, sf_dir):
    """Distinct speakers per split as rows, for vocabularies too long for one array."""
    return distinct_values(utt(spark, sf_dir), "speaker_id", ["original_split"])


@query(
    """SELECT doc_id, original_split, row_number() OVER (PARTITION BY original_split ORDER BY doc_id) - 1 AS pos
       FROM utt""",
    ("utt",),
)
def q_position_index(spark, sf_dir):
    rows = utt(spark, sf_dir).select("doc_id", "original_split")
    return dense_positions(rows, "doc_id", ["original_split"])


@query(
    """SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(text), doc_id) - 1 AS pos FROM documents""",
)
def q_position_by_text(spark, sf_dir):
    """Positions in an order that is no integer key: a text digest, then the id."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5("text").alias("digest"))
    return dense_positions(rows, ["digest", "doc_id"], ["lang"]).select("doc_id", "pos")


@query(f"WITH {_ANNOTATED} SELECT doc_id, speaker_id, speaker_name, _key FROM annotated", ("utt",))
def q_speaker_annotate(spark, sf_dir):
    rows = utt(spark, sf_dir).select("doc_id", "original_split")
    return annotate_corpus(rows, "doc_id").select("doc_id", "speaker_id", "speaker_name", "_key")


@query(
    f"""WITH {_ANNOTATED},
    sizes AS (SELECT speaker_id, count(*) AS n FROM annotated WHERE speaker_id <> 'speaker_unknown' GROUP BY 1),
    bottom AS (SELECT speaker_id FROM sizes ORDER BY n, speaker_id LIMIT 2)
    SELECT CASE WHEN speaker_id IN (SELECT speaker_id FROM bottom) THEN 'test' ELSE 'train' END AS split,
           speaker_id, count(*) AS n FROM annotated GROUP BY ALL""",
    ("utt",),
)
def q_job_speaker_split(spark, sf_dir):
    """Number, annotate and split the corpus; unknown speakers stay in train."""
    rows = utt(spark, sf_dir).select("doc_id", "original_split")
    labelled = speaker_split(annotate_corpus(rows, "doc_id"))
    return labelled.groupBy("split", "speaker_id").agg(F.count(F.lit(1)).alias("n"))


# Ranges that overlap, one for each good document, ten positions long.
_OVERLAPS = """
    ranges AS (SELECT original_split, original_index AS lo, original_index + 9 AS hi,
                      CAST(doc_id AS INTEGER) AS num, lang AS name, doc_id AS map_order
               FROM utt JOIN labels USING (doc_id) WHERE quality = 1),
    found AS (SELECT u.doc_id, min(map_order) AS map_order FROM utt u LEFT JOIN ranges r
              ON r.original_split = u.original_split AND u.original_index BETWEEN lo AND hi GROUP BY 1)
    SELECT f.doc_id, CASE WHEN num IS NULL THEN 'speaker_unknown' ELSE printf('speaker_%02d', num) END AS speaker_id,
           coalesce(name, 'Unknown') AS speaker_name
    FROM found f LEFT JOIN ranges USING (map_order)"""


def _overlapping_map(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return utt(spark, sf_dir).join(good, "doc_id").select(
        F.col("original_split").alias("split"),
        F.col("original_index").alias("lo"),
        (F.col("original_index") + 9).alias("hi"),
        F.col("doc_id").cast("int").alias("num"),
        F.col("lang").alias("name"),
        F.col("doc_id").alias("map_order"),
    )


@query(f"WITH {_OVERLAPS}", ("utt",))
def q_speaker_overlaps(spark, sf_dir):
    """A range map made from the data, with overlaps: the first range wins."""
    rows = utt(spark, sf_dir).select("doc_id", "original_split", "original_index")
    found = annotate_speakers(rows, _overlapping_map(spark, sf_dir))
    return found.select("doc_id", "speaker_id", "speaker_name")


@query(f"WITH {_OVERLAPS}", ("utt",))
def q_speaker_overlaps_bucketed(spark, sf_dir):
    """The same through the bucketed join, as for a map too large to broadcast."""
    rows = utt(spark, sf_dir).select("doc_id", "original_split", "original_index")
    found = annotate_speakers(rows, _overlapping_map(spark, sf_dir), broadcast_rows=0)
    return found.select("doc_id", "speaker_id", "speaker_name")


@query(
    """SELECT source AS speaker_id, n, map_order FROM (SELECT source, count(*) AS n, min(doc_id) AS map_order FROM documents GROUP BY source)
       ORDER BY n, map_order LIMIT 3""",
)
def q_bottom_speakers_map_order(spark, sf_dir):
    """The smallest speakers, of equal ones those that come first in the map: sources in order of their first document."""
    sizes = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("speaker_id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("map_order")
    )
    return smallest_speakers(sizes, 3, tie_break="map_order")


@query(
    """WITH r AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'dev' ELSE 'eval' END AS split, l_orderkey AS lo,
                         l_orderkey + 100 * l_suppkey + 1000 * l_linenumber AS hi, CAST(l_suppkey AS INTEGER) AS num,
                         CAST(l_partkey AS BIGINT) * 1000000000 + l_orderkey * 8 + l_linenumber AS map_order FROM lineitem),
            p AS (SELECT doc_id, original_split, 50 * original_index AS pos FROM utt)
       SELECT doc_id, CASE WHEN w IS NULL THEN 'speaker_unknown' ELSE printf('speaker_%02d', w) END AS speaker_id
       FROM (SELECT doc_id, arg_min(num, map_order) AS w FROM p LEFT JOIN r ON split = original_split AND pos BETWEEN lo AND hi GROUP BY doc_id)""",
    ("utt",),
)
def q_speaker_sweep(spark, sf_dir):
    """A map of as many ranges as there are order lines, long and nested in thousands: a distributed sweep makes it
    disjoint, so that each position meets one range."""
    lines = table(spark, sf_dir, "lineitem")
    ranges = lines.select(
        F.when(F.col("l_linenumber") % 2 == 0, "dev").otherwise("eval").alias("split"),
        F.col("l_orderkey").cast("bigint").alias("lo"),
        (F.col("l_orderkey") + 100 * F.col("l_suppkey") + 1000 * F.col("l_linenumber")).cast("bigint").alias("hi"),
        F.col("l_suppkey").cast("int").alias("num"),
        F.lit("").alias("name"),
        (F.col("l_partkey").cast("bigint") * 1_000_000_000 + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("map_order"),
    )
    rows = utt(spark, sf_dir).select("doc_id", "original_split", (50 * F.col("original_index")).alias("original_index"))
    return annotate_speakers(rows, ranges).select("doc_id", "speaker_id")


@query(
    "SELECT doc_id, original_index FROM utt WHERE original_split = 'dev' ORDER BY original_index LIMIT 50", ("utt",)
)
def q_first_n(spark, sf_dir):
    dev = utt(spark, sf_dir).where("original_split = 'dev'").select("doc_id", "original_index")
    return first_rows(dev, 50, "original_index")


@query(
    """SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) - 1 AS selected_id FROM documents
       ORDER BY selected_id LIMIT 100""",
)
def q_seeded_sample(spark, sf_dir):
    return seeded_sample(table(spark, sf_dir, "documents").select("doc_id"), 100, "doc_id", seed=0)


@query(
    """SELECT doc_id, row_number() OVER (ORDER BY CASE original_split WHEN 'dev' THEN 0 ELSE 1 END, original_index) - 1
              AS global_pos FROM utt""",
    ("utt",),
)
def q_concat_ordered(spark, sf_dir):
    """Dev, then eval, numbered as one table."""
    rows = utt(spark, sf_dir).select("doc_id", "original_split", "original_index")
    return concat_in_order(rows, "original_split", ["dev", "eval"], "original_index").select("doc_id", "global_pos")
