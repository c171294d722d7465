"""Incremental building: each run handles the utterances that arrived since the last one."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechset.operators.positions import content_hash
from speechset.session import file_system, small_table
from speechset.streaming.history import finished_before, remember, remembered

log = logging.getLogger(__name__)


def read_batches(spark: SparkSession, output: str) -> DataFrame | None:
    """All rows built so far with the ``batch_id`` that built them; None before the first batch."""
    try:
        return spark.read.parquet(output)
    except PySparkException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def first_of_keys(df: DataFrame, key: str) -> DataFrame:
    """One row per key, chosen by a digest of its content; all rows whose key is null."""
    content = content_hash(df, [key])
    rank = F.row_number().over(Window.partitionBy(key, F.when(F.col(key).isNull(), content)).orderBy(content))
    return df.withColumn("_rank", rank).where((F.col("_rank") == 1) | F.col(key).isNull()).drop("_rank")


def build_arrivals(
    spark: SparkSession,
    arrivals: str,
    schema: str,
    output: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
    key: str = "_key",
    files_per_batch: int = 10,
    done: str | None = None,
    publish: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process all files in ``arrivals`` that no earlier run has, in batches, then stop.

    What is finished is kept by key in ``<output>_index``, with filters by which a batch reads only the keys of
    batches that some of its own rows were in (``streaming.history``); batches that it lacks are added to it.
    A batch builds the rows whose key is not finished yet, and replaces the folder of its own batch
    id: a batch that is run again after a failure leaves its rows once. ``done`` is the condition for
    a finished row (all rows if None), so failed rows are tried again when they arrive again.
    ``publish`` is called after each batch; if it fails, the run goes on and the failure is kept as
    a row in ``<output>_publish_log``.
    """

    index = f"{output}_index"

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Of rows that repeat a key the smallest counts, whatever the order of arrival; rows without a
        # key are all kept.
        todo = first_of_keys(batch, key)
        _remember_missing(session, output, index, key, done, batch_id)
        finished = finished_before(todo.select(F.col(key).alias("key")), index, batch_id)
        todo = todo.join(finished, todo[key].cast("string") == finished["key"], "left_anti")
        build(todo).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        _remember(session, output, index, key, done, batch_id)
        if publish is not None:
            report = "published"
            try:
                publish(session.read.parquet(output), batch_id)
            except Exception as failure:
                report = f"{type(failure).__name__}: {failure}"
                log.warning("publishing after batch %s failed: %s", batch_id, report)
            log_row = small_table(session, [(batch_id, report)], "batch_id bigint, report string")
            log_row.write.mode("overwrite").json(f"{output}_publish_log/run={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _remember(spark: SparkSession, output: str, index: str, key: str, done: str | None, batch_id: int) -> None:
    built = spark.read.parquet(f"{output}/batch_id={batch_id}")
    finished = built.where(done) if done is not None else built
    remember(finished.select(F.col(key).alias("key")), index, batch_id)


def _remember_missing(spark: SparkSession, output: str, index: str, key: str, done: str | None, batch_id: int) -> None:
    """Batches that were committed without an entry: a run that stopped between the two, or an older version's."""
    store, place = file_system(output)
    if not store.exists(place):
        return
    names = [status.getPath().getName() for status in store.listStatus(place)]  # one entry a batch
    there = {int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")}
    for missing in sorted(there - remembered(spark, index) - {batch_id}):
        try:
            _remember(spark, output, index, key, done, missing)
        except PySparkException as failure:
            if failure.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a batch that was never committed
                raise


def compact(spark: SparkSession, output: str, target: str, key: str = "_key", done: str | None = None) -> DataFrame:
    """The final table: one row per key. A finished row beats a failed one, then the latest batch wins.

    Only keys built more than once are looked up; the rows themselves, which may carry audio, stay
    where they are when these are few.
    """
    built = spark.read.parquet(output)
    finished = F.coalesce(F.expr(done), F.lit(False)) if done else F.lit(True)
    again = (
        built.groupBy(F.col(key).alias("_again"))
        .agg(
            F.count(F.lit(1)).alias("_times"),
            F.coalesce(F.max(F.when(finished, F.col("batch_id"))), F.max("batch_id")).alias("_winner"),
        )
        .where("_times > 1")
    )
    kept = built.join(again, F.col(key) == F.col("_again"), "left").where("_winner IS NULL OR _winner = batch_id")
    kept.drop("batch_id", "_again", "_times", "_winner").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
