"""Restarted runs and run reports."""

from pyspark.sql import functions as F

from speechset.operators.reports import planned_work, run_summary
from speechset.operators.resume import completed_rows, merge_runs, pending_rows, resume_progress
from suite.fixtures import prior, table, utt
from suite.registry import query

# Files exist for finished clips, except those whose label is toxic: these were lost.
_DONE = "SELECT doc_id FROM prior WHERE cloned_audio_fr <> '' AND toxic = 0"


def _existing_files(spark, sf_dir):
    return prior(spark, sf_dir).where("cloned_audio_fr <> '' AND toxic = 0").select("cloned_audio_fr")


def _completed(spark, sf_dir):
    return completed_rows(prior(spark, sf_dir), _existing_files(spark, sf_dir), key="doc_id")


@query(f"SELECT doc_id FROM documents WHERE doc_id NOT IN ({_DONE})", ("prior",))
def q_resume_pending(spark, sf_dir):
    """What a restart has to do: never tried, failed, or finished with its file lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return pending_rows(docs, _completed(spark, sf_dir), "doc_id")


@query(
    """WITH runs AS (SELECT doc_id, cloned_audio_fr AS path, 1 AS run FROM prior
                     UNION ALL SELECT doc_id, CASE WHEN toxic = 0 THEN 'second_' || doc_id ELSE '' END, 2 FROM prior),
            last AS (SELECT doc_id, arg_max(path, run) AS path FROM runs WHERE path <> '' GROUP BY 1)
       SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'new' ELSE 'old' END AS origin,
              coalesce(l.path, 'built_' || d.doc_id) AS path
       FROM documents d LEFT JOIN last l USING (doc_id)""",
    ("prior",),
)
def q_resume_merge(spark, sf_dir):
    """Two earlier runs and the new one: the last finished row of a key wins, the rest are new."""
    first = prior(spark, sf_dir).select("doc_id", F.col("cloned_audio_fr").alias("path"), F.lit(1).alias("run"), "toxic")
    second = first.select(
        "doc_id", F.when(F.col("toxic") == 0, F.concat(F.lit("second_"), "doc_id")).otherwise("").alias("path"), F.lit(2).alias("run"), "toxic"
    )
    done = completed_rows(first.unionByName(second), None, "doc_id", "path", "run")
    old = done.select("doc_id", F.lit("old").alias("origin"), "path")
    new = table(spark, sf_dir, "documents").select(
        "doc_id", F.lit("new").alias("origin"), F.concat(F.lit("built_"), "doc_id").alias("path")
    )
    return merge_runs(old, new, "doc_id")


@query(
    f"""SELECT count(*) FILTER (WHERE doc_id IN ({_DONE})) AS completed, count(*) AS total,
               count(*) FILTER (WHERE doc_id NOT IN ({_DONE})) AS pending FROM documents""",
    ("prior",),
)
def q_resume_progress(spark, sf_dir):
    return resume_progress(table(spark, sf_dir, "documents").select("doc_id"), _completed(spark, sf_dir), "doc_id")


@query(
    """SELECT original_split AS split, count(*) FILTER (WHERE cloned_audio_fr <> '') AS ok,
              count(*) FILTER (WHERE error <> '') AS errors, count(*) AS total
       FROM utt LEFT JOIN prior USING (doc_id) GROUP BY 1""",
    ("utt", "prior"),
)
def q_run_summary(spark, sf_dir):
    rows = utt(spark, sf_dir).select("doc_id", F.col("original_split").alias("split"))
    return run_summary(rows.join(prior(spark, sf_dir), "doc_id", "left"))


@query(
    """SELECT 'rows' AS what, count(*) * 3 AS clips FROM documents
       UNION ALL SELECT 'grid', (SELECT count(*) FROM region) * count(DISTINCT lang) * 10 FROM documents""",
)
def q_work_size(spark, sf_dir):
    """Clips a run will make: rows times languages, and voices times languages times sentences."""
    docs = table(spark, sf_dir, "documents")
    voices = table(spark, sf_dir, "region").count()
    rows = planned_work(docs, 3).select(F.lit("rows").alias("what"), "clips")
    grid = planned_work(docs.select("lang").distinct(), voices * 10).select(F.lit("grid").alias("what"), "clips")
    return rows.unionByName(grid)
