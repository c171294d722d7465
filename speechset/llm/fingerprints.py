"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points has a rolling hash. From each window of ``WINDOW`` consecutive hashes the
smallest is chosen, the rightmost among equals, and kept with its position. Any two texts that share
``GRAM + WINDOW - 1`` code points in a row share a chosen hash, wherever the passage stands. With these values
that is 39, so an edit that leaves half of a text is certain to be seen from 77 code points on.

Cases: a null text is empty; an empty text has an empty fingerprint; a text shorter than a run has one hash,
of all of it; a text with fewer hashes than a window has one window. Equal texts have equal fingerprints.
Null ids come last in descending order; rows that repeat an id follow each other by a hash of their text.
Rows without an id, and those of an id that very many rows have, are cut by that hash. All rows of one id and
text but the last are followed by their like, so a task keeps the first it meets in the order and deals the
others out evenly. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.llm.frames import slices, texts
from speechset.llm.words import mix
from speechset.session import small_table

GRAM = 24
WINDOW = 16
HELD = 1 << 18  # ids and hashes of texts that a task remembers to tell copies; the first copy after more is one of the order
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)
_ENTRY = np.dtype([("hash", "<u8"), ("position", "<u4")])


def _rolled(points: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of each run of ``size`` values (the last ``size - 1`` are void), by doubling."""
    total, done = np.zeros(len(points), np.uint64), 0
    power, width, base = mix(points), 1, _BASE
    left = size
    while left:
        if left & 1:  # append a block of the present width to what is hashed so far
            part = np.zeros(len(points), np.uint64)
            part[: max(len(points) - done, 0)] = power[done:]
            total = total * base + part
            done += width
        left >>= 1
        if left:
            ahead = np.zeros(len(points), np.uint64)
            ahead[: max(len(points) - width, 0)] = power[width:]
            power = power * base + ahead
            base, width = base * base, width * 2
    return mix(total)


def _rightmost_minima(values: np.ndarray, size: int) -> np.ndarray:
    """For each start, the place of the smallest of ``size`` values from there, rightmost among equals."""
    least, place, width = values.copy(), np.arange(len(values)), 1
    while width < size:
        by = min(width, size - width)
        if len(values) <= by:
            break
        right = least[by:] <= least[:-by]
        place[:-by] = np.where(right, place[by:], place[:-by])
        least[:-by] = np.where(right, least[by:], least[:-by])
        width += by
    return place


def winnow(strings: list[str], gram: int = GRAM, window: int = WINDOW) -> list[np.ndarray]:
    """The fingerprint of each text: an array of chosen hashes and their positions, in order."""
    sizes = np.array([len(s) for s in strings], np.int64)
    points = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4").astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    hashes = _rolled(points, gram) if len(points) else np.zeros(0, np.uint64)
    count = np.where(sizes > 0, np.maximum(sizes - gram + 1, 1), 0)
    for i in np.flatnonzero((sizes > 0) & (sizes < gram)):
        own = points[offsets[i] : offsets[i + 1]]
        hashes[offsets[i]] = _rolled(own, len(own))[0] ^ np.uint64(len(own))
    minima = _rightmost_minima(hashes, window)
    out = []
    for start, n in zip(offsets[:-1].tolist(), count.tolist()):
        if n >= window:
            chosen = minima[start : start + n - window + 1]
            chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
        elif n:
            own = hashes[start : start + n]
            chosen = start + np.flatnonzero(own == own.min())[-1:]
        else:
            chosen = np.zeros(0, np.int64)
        entry = np.empty(len(chosen), _ENTRY)
        entry["hash"], entry["position"] = hashes[chosen], chosen - start
        out.append(entry)
    return out


def as_text(fingerprint: np.ndarray) -> str:
    """Twelve bytes an entry (hash, position; little-endian) in base 64."""
    return base64.b64encode(fingerprint.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among all distinct hashes of both; two empty fingerprints are alike."""
    if not len(a) and not len(b):
        return 1.0
    x, y = np.unique(a["hash"]), np.unique(b["hash"])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint of each text as two lists, ``hashes`` and ``positions``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            found = winnow([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([f["hash"].astype(np.int64).tolist() for f in found], pa.list_(pa.int64())),
                 pa.array([f["position"].astype(np.int64).tolist() for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "hashes", "positions"],
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id bigint, hashes array<bigint>, positions array<bigint>")


def _at_least(bounds: list[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are at least ``value``: first by blocks, then inside one block."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    longs = lambda x: F.array(*[F.lit(v).cast("bigint") for v in x])
    lasts, every = longs([b[-1] for b in blocks]), longs(bounds)
    skip = F.size(F.filter(lasts, lambda b: b < value)) * width  # blocks that lie below entirely
    inside = F.size(F.filter(F.slice(every, skip + 1, width), lambda b: b < value))
    return F.when(skip >= len(bounds), F.lit(0)).otherwise(F.lit(len(bounds)) - skip - inside)


def _parts(docs: DataFrame, n: int) -> tuple[Column, int]:
    """The part of each row by descending id, and how many parts there are: about ``n`` equal ones and one for each
    bound. An id with the rows of several parts has as many of its own, cut by ``_order``, as have rows without an id."""
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    # One bound for each part comes to the driver.
    found = docs.agg(
        F.percentile_approx("doc_id", shares, F.lit(20 * n)).alias("b"), F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("n")
    ).first()
    often = Counter(found["b"] or []) if n > 1 else Counter()
    bounds = sorted(often, reverse=True)
    own = [0] + [often[b] if often[b] > 1 else 0 for b in bounds]  # parts that the largest id of a block has for itself
    first = np.concatenate([[0], np.cumsum([k + 1 for k in own])]).tolist()
    nameless = max(1, round(n * (found["n"] - found["named"]) / max(found["n"], 1)))
    block = _at_least(bounds[::-1], F.col("doc_id"))
    longs = lambda x: F.array(*[F.lit(v).cast("bigint") for v in x])
    of = lambda x: F.get(longs(x), block)
    share = F.col("_order") / F.lit(2.0**64) + 0.5
    cut = lambda k: F.least(F.floor(share * k), k - 1)
    hot = (F.col("doc_id") == of([0, *bounds])) & (of(own) > 0)
    named = of(first) + F.when(hot, cut(of(own))).otherwise(of(own))
    part = F.when(F.col("doc_id").isNull(), F.lit(first[-1]) + cut(F.lit(nameless))).otherwise(named)
    return part.cast("int"), first[-1] + nameless


def _deal_copies(batches: Iterator[pa.RecordBatch], parts: int, held: int) -> Iterator[pa.RecordBatch]:
    """Mark each row whose id and text the task has met (``_like``: the next row is its like), and deal it anywhere."""
    seen: dict[tuple, int] = {}
    for batch in batches:
        if len(seen) > held:
            seen.clear()
        order = batch.column("_order").to_numpy()
        nth = np.zeros(batch.num_rows, np.uint64)
        for k, key in enumerate(zip(batch.column("doc_id").to_pylist(), order.tolist())):
            nth[k] = seen.get(key, 0)
            seen[key] = int(nth[k]) + 1
        anywhere = (mix(order.view(np.uint64) + nth) % np.uint64(parts)).astype(np.int32)
        part = np.where(nth > 0, anywhere, batch.column("_part").to_numpy())
        columns = [batch.column("doc_id"), batch.column("text"), batch.column("_order"), pa.array(part, pa.int32()), pa.array(nth > 0)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "_order", "_part", "_like"])


def followed(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) dealt into ``_part`` by descending id. The first row of each part is
    also at the end of the part before it, marked ``_tail``; that of the first part at the end of the last.
    Rows marked ``_like`` come before the others of a part and are followed by their like. One shuffle of the
    texts; a row more for each part and task that has its first row."""
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.withColumn("_order", F.xxhash64("text"))
    number, count = _parts(docs, n)
    keyed = ordered.withColumn("_part", number)
    # One head for each part comes to the driver. The complement of an id turns its order round.
    key = F.struct(F.bitwise_not("doc_id").alias("i"), F.col("_order").alias("o"))
    heads = sorted(keyed.groupBy("_part").agg(F.min(key).alias("k")).select("_part", "k.i", "k.o").collect())
    before = [(None if i is None else ~i, o, heads[k - 1][0]) for k, (_, i, o) in enumerate(heads)]
    table = small_table(docs.sparkSession, before, "h_id bigint, h_order bigint, before int")
    held = HELD
    marked = keyed.mapInArrow(lambda b: _deal_copies(b, count, held), "doc_id bigint, text string, _order bigint, _part int, _like boolean")
    is_head = ~F.col("_like") & F.col("doc_id").eqNullSafe(F.col("h_id")) & F.col("_order").eqNullSafe(F.col("h_order"))
    also = marked.join(F.broadcast(table), is_head, "left")
    own = F.struct(F.col("_part"), F.lit(False).alias("_tail"))
    tail = F.struct(F.col("before").alias("_part"), F.lit(True).alias("_tail"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, tail))
    dealt = also.select("doc_id", "text", "_order", "_like", F.explode(places).alias("p")).select("doc_id", "text", "_order", "_like", "p.*")
    by = ["_part", F.desc("_like"), "_tail", F.col("doc_id").desc_nulls_last(), "_order"]
    return dealt.repartitionById(count, "_part").sortWithinPartitions(*by)


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, both fingerprints and how near the text is to its edit and to
    the next text. The edit puts the start of the next text in the place of the last half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, waiting for the one after it
        for batch in slices(batches, limit=1 << 20):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_like", "_tail"))))
            rows = ([held] if held else []) + [(i, t or "", like, tail) for i, t, like, tail in rows]
            held = None if rows[-1][2] else rows[-1]
            pairs = [(k, k if like else k + 1) for k, (_, _, like, tail) in enumerate(rows) if like or not tail]
            pairs = [(a, b) for a, b in pairs if b < len(rows)]
            edits = [_edited(rows[a][1], rows[b][1]) for a, b in pairs]
            own, new = winnow([r[1] for r in rows]), winnow(edits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[a][0] for a, _ in pairs], pa.int64()),
                 pa.array([len(rows[a][1]) for a, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                 pa.array([as_text(own[a]) for a, _ in pairs], pa.string()),
                 pa.array([as_text(f) for f in new], pa.string()),
                 pa.array([likeness(own[a], f) for (a, _), f in zip(pairs, new)], pa.float64()),
                 pa.array([likeness(own[a], own[b]) for a, b in pairs], pa.float64())],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return followed(texts(df, id_col, text_col)).mapInArrow(run, schema)


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]
