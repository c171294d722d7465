"""Publishing splits as one dataset."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechset.functions.audio import AUDIO_TYPE, decode_wav
from speechset.operators.jobs import apply_job
from speechset.session import qualified
from speechset.sinks.audio_files import open_filesystem


def embed_audio(df: DataFrame, column: str) -> DataFrame:
    """Replace a path column by the audio it points to. Each task opens the files of its own rows, so
    no audio is shuffled. A missing file gives null and the reason in ``<column>_error``."""

    default = qualified("/")

    def open_function() -> Callable:
        def load(path):
            if path is None:
                return None, None
            store, plain = open_filesystem(default + path if path.startswith("/") else path)
            with store.open_input_stream(plain) as src:
                samples, rate, _ = decode_wav(src.read())
            return samples, rate

        return load

    output = StructType.fromDDL("_array array<float>, _rate int")
    loaded = apply_job(df, open_function, [column], output, drop=[column], error=f"{column}_error")
    audio = F.when(F.col("_array").isNotNull(), F.struct(F.col("_array").alias("array"), F.col("_rate").alias("sampling_rate")))
    columns = [audio.cast(AUDIO_TYPE).alias(column) if c == column else F.col(c) for c in df.columns]
    return loaded.select(*columns, f"{column}_error")


def write_dataset(df: DataFrame, folder: str, partition: str = "split", rebalance: bool = True) -> None:
    """Parquet partitioned by split. Rebalancing cuts a dominant split into even files and keeps a
    small one from being scattered; turn it off when rows carry audio, to write without a shuffle."""
    out = df.hint("rebalance", partition) if rebalance else df
    out.write.mode("overwrite").partitionBy(partition).parquet(folder)


def dataset_manifest(df: DataFrame, partition: str = "split", paths: Sequence[str] = ()) -> DataFrame:
    """Per split: rows, and rows with a value in each of the ``paths`` columns."""
    return df.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(p).alias(f"n_{p}") for p in paths]
    )
