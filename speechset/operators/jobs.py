"""Batch inference: a user function per row, with failures kept as error text."""

from __future__ import annotations

import hashlib
import sys
import traceback
import types as pytypes
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import Array
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType

from speechset.constants import CFG_FLOOR


# Results that are held before an output batch is handed on.
OUTPUT_BYTES = 32 * 1024 * 1024
# Models that a Python worker keeps open; the one used longest ago goes first.
OPEN_MODELS = 2


def cfg_weight(column: Column) -> Column:
    """The guidance weight, never exactly zero."""
    return F.greatest(column, F.lit(CFG_FLOOR))


def _opened(job: str, open_function: Callable[[], Callable]) -> Callable:
    """The function of a job, opened once in a Python worker for as long as it stays among the last used."""
    holder = sys.modules.setdefault("_speechset_worker", pytypes.ModuleType("_speechset_worker"))
    cache: OrderedDict = holder.__dict__.setdefault("opened", OrderedDict())
    if job not in cache:
        while len(cache) >= OPEN_MODELS:
            cache.popitem(last=False)
        cache[job] = open_function()
    cache.move_to_end(job)
    return cache[job]


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Hash the work list over ``tasks`` partitions: for rows that weigh little and cost much, such as
    sentences to synthesise. By row key, never by speaker or language. None keeps the scan's partitions."""
    return df.repartition(tasks, *keys) if tasks else df


def apply_job(
    df: DataFrame,
    open_function: Callable[[], Callable],
    inputs: Sequence[str],
    outputs: StructType,
    drop: Sequence[str] = (),
    error: str = "error",
    batch: int | None = None,
) -> DataFrame:
    """Call a function on the ``inputs`` of every row and append its results as ``outputs``.

    ``open_function`` runs once per Python worker and returns the function, so a model is loaded
    once, also over several calls with the same opener (compared by its serialised content). With
    ``batch`` the function takes a list of up to so many input tuples and returns as many results; an
    exception then counts for the whole list. Otherwise the function returns one value per output. An exception leaves the outputs null and its
    traceback in ``error``. Rows that already have an error are passed by. Only the inputs of the
    other rows travel to Python; all other columns stay in the JVM. ``drop`` leaves out columns that
    are no longer needed. Input batches are bounded by the session's Arrow settings, output batches
    by ``OUTPUT_BYTES``.
    """
    known = F.coalesce(F.col(error), F.lit("")) if error in df.columns else F.lit("")
    kept = [c for c in df.columns if c not in drop and c != error]
    returned = StructType([*outputs.fields, StructField("_failure", StringType())])
    arrow_type = to_arrow_type(returned)
    inputs, job = list(inputs), hashlib.sha256(cloudpickle.dumps(open_function)).hexdigest()
    is_array = [isinstance(df.schema[c].dataType, ArrayType) for c in inputs]

    def run(batches: Iterator[tuple[Array, ...]]) -> Iterator[Array]:
        function = _opened(job, open_function)
        for wanted, *columns in batches:
            results, size = [], 0
            for (*result, failure) in _results(function, wanted, columns):
                results.append((*result, failure))
                size += sum(getattr(value, "nbytes", 64) for value in result)
                if size >= OUTPUT_BYTES:
                    yield _struct_array(results, arrow_type)
                    results, size = [], 0
            if results:
                yield _struct_array(results, arrow_type)

    def _results(function: Callable, wanted: Array, columns: list[Array]) -> Iterator[tuple]:
        nothing, flags = (None,) * len(outputs), wanted.to_pylist()
        step = batch or 1
        for at in range(0, len(flags), step):
            rows = [i for i in range(at, min(at + step, len(flags))) if flags[i]]
            found, failure = [nothing] * len(rows), ""
            if rows:
                try:
                    given = [tuple(_value(c[i], array) for c, array in zip(columns, is_array)) for i in rows]
                    found = [tuple(r) for r in (function(given) if batch else [function(*given[0])])]
                    if len(found) != len(rows):
                        raise ValueError(f"{len(found)} results for {len(rows)} inputs")
                except Exception:
                    found, failure = [nothing] * len(rows), traceback.format_exc()
            by_row = dict(zip(rows, found))
            for i in range(at, min(at + step, len(flags))):
                yield (*by_row.get(i, nothing), failure if flags[i] else "")

    # A model call must not be repeated or moved by the optimizer.
    call = F.arrow_udf(run, returned).asNondeterministic()
    wanted = known == ""
    result = call(wanted, *[F.when(wanted, F.col(c)) for c in inputs])
    made = df.withColumn("_result", result)
    return made.select(
        *kept,
        *[F.col(f"_result.{f.name}").alias(f.name) for f in outputs],
        F.when(wanted, F.col("_result._failure")).otherwise(known).alias(error),
    )


def _struct_array(results: list[tuple], kind: pa.StructType) -> pa.Array:
    fields = [pa.array([r[k] for r in results], type=kind.field(k).type) for k in range(kind.num_fields)]
    return pa.StructArray.from_arrays(fields, fields=list(kind))


def _value(scalar: pa.Scalar, is_array: bool):
    if not scalar.is_valid:
        return None
    return scalar.values.to_numpy(zero_copy_only=False) if is_array else scalar.as_py()


CLIP_OUTPUT = StructType(
    [StructField("out_array", ArrayType(FloatType())), StructField("out_rate", IntegerType())]
)


def _as_clip(open_model: Callable[[], Callable]) -> Callable[[], Callable]:
    def open_function() -> Callable:
        model = open_model()

        def call(*args):
            samples, rate = model(*args)
            return np.asarray(samples, dtype=np.float32).reshape(-1), int(rate)

        return call

    return open_function


def synthesize(df: DataFrame, open_model: Callable[[], Callable], inputs: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Run a synthesis function that returns (samples, rate); adds ``out_array, out_rate, error``."""
    return apply_job(df, _as_clip(open_model), inputs, CLIP_OUTPUT, drop)


def encode_references(df: DataFrame, open_encoder: Callable[[], Callable], audio: str = "audio") -> DataFrame:
    """Turn each reference clip into marker text once, before rows are repeated per language.

    The encoder takes (samples, rate) and returns codes. The audio itself is left behind. A clip
    that cannot be encoded keeps its row, with the error.
    """
    flat = df.withColumns({"_array": F.col(audio)["array"], "_rate": F.col(audio)["sampling_rate"]}).drop(audio)

    def open_function() -> Callable:
        encoder = open_encoder()
        return lambda samples, rate: ([int(c) for c in encoder(samples, rate)],)

    output = StructType([StructField("ref_codes", ArrayType(IntegerType()))])
    return apply_job(flat, open_function, ["_array", "_rate"], output, drop=["_array", "_rate"])
