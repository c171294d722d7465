"""One WAV file per clip, written by the tasks that hold the clips."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechset.functions.audio import encode_wav
from speechset.operators.jobs import apply_job
from speechset.session import qualified


def open_filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a local folder or a URI (``file:``, ``hdfs:``, ``s3a:``, ``gs:``)."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" not in folder:
        return pafs.LocalFileSystem(), folder
    scheme, rest = folder.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


# Stores where a file appears whole when its stream is closed, in place of an older one.
WHOLE_ON_CLOSE = ("s3", "gcs", "abfs")


def put_file(store: pafs.FileSystem, path: str, content: bytes) -> None:
    """Put a whole file in place: a retried or doubled task leaves the same bytes, and readers never see a part of them.

    Object stores show a file when it is complete. Elsewhere it is written under a name of its own and moved; a store that does
    not move over a file keeps one that has the size of the new one, so that a doubled task takes nothing away."""
    if store.type_name in WHOLE_ON_CLOSE:
        with store.open_output_stream(path) as out:
            out.write(content)
        return
    store.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        out.write(content)
    if store.type_name != "local":
        old = store.get_file_info(path)
        if old.type != pafs.FileType.NotFound and old.size == len(content):
            store.delete_file(part)
            return
        if old.type != pafs.FileType.NotFound:
            store.delete_file(path)
    store.move(part, path)


def write_audio_files(df: DataFrame, folder: str, path: str = "path", audio: str = "audio", prefix: str = "") -> DataFrame:
    """Write each row's clip to ``folder/<path>``; adds ``<prefix>n_samples`` and updates ``error``.

    The files appear when the result is computed; computing it again writes the same files.
    """
    flat = df.withColumns({"_array": F.col(audio)["array"], "_rate": F.col(audio)["sampling_rate"]}).drop(audio)
    target = qualified(folder)

    def open_function() -> Callable:
        store, base = open_filesystem(target)

        def write(name, samples, rate):
            if samples is None or not name:
                return (None,)
            put_file(store, f"{base}/{name}", encode_wav(samples, rate))
            return (len(samples),)

        return write

    output = StructType.fromDDL(f"{prefix}n_samples bigint")
    return apply_job(flat, open_function, [path, "_array", "_rate"], output, drop=["_array", "_rate"])


def require_written(report: DataFrame, path: str = "path") -> None:
    """Write the files of a ``write_audio_files`` result now; an error if one of them failed."""
    failed = F.col("error") != ""
    first = F.min(F.when(failed, F.struct(path, "error"))).alias("first")
    summary = report.agg(F.count_if(failed).alias("n"), first).first()
    if summary.n:
        raise RuntimeError(f"{summary.n} clips not written, such as {summary['first'][0]}: {summary['first'][1]}")
