"""Exact substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Each window has a minimiser, the smallest hash of
its runs of ``MINIMISER`` words. Consecutive windows with the same minimiser form a super-k-mer, which
travels as one packed string to the bucket of that minimiser; equal windows have equal minimisers and
so meet in one bucket, where sorting counts them exactly. A word is removed if a window that covers it
also starts anywhere else.

* Minimisers are counted first, with partial sums. A minimiser found at one place only cannot belong to
  a repeated window, so its super-k-mers stay where they are. The others are packed.
* Equal packed strings of a batch travel once, with their number, so a passage with countless copies
  sends a string per batch and not per copy. The verdict goes back to the places by a join that Spark
  can split when one string has very many places.
* Minimisers with more than ``HOT`` places (a frequent phrase with varying surroundings) are not used as
  buckets: their windows travel one by one, each to the bucket of its own hash.

Cases: a null text has no words; a text shorter than a window loses nothing; a null id is an id of its
own; rows that repeat an id and text count as separate places, so both lose their windows. An empty
table gives an empty result. Other columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechset.llm.frames import fresh, quoted, slices
from speechset.llm.words import Words, cover, grams, hash_ranges, mix

WINDOW = 35
MINIMISER = 4
HOT = 1 << 17
LONGEST_RUN = 256  # windows in one packed string
GROUP_BYTES = 4 << 20  # packed strings that a bucket task looks at together, unless one bucket has more
_KEY = ["_a", "_b"]


def _keyed(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """``df`` with a key that is never null and tells equal ids with different texts apart. All steps
    join on this one table, so that its rows are shuffled once and the exchange is used again."""
    names = [fresh(df, "_a"), fresh(df, "_b")]
    id_, text = quoted(id_col).cast("bigint"), quoted(text_col).cast("string")
    return df.withColumns({names[0]: F.coalesce(id_, F.lit(0)), names[1]: F.xxhash64(id_, text), text_col: text}), names


def runs_of(words: Words, size: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of a column: first word, number of windows, minimiser, and whether one of the m-word
    runs in it occurs twice (without that, no window can occur twice in it)."""
    starts = words.fits(size)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    values = grams(words.hashes(), m)
    span = size - m + 1
    least, width = values.copy(), 1
    while width < span:
        by = min(width, span - width)
        least[: len(least) - by] = np.minimum(least[: len(least) - by], least[by:])
        width += by
    near = np.zeros(len(values) + 1, np.int64)  # repeats of an m-word run within a window's length
    for gap in range(1, span + 1):
        near[gap:-1] |= values[gap:] == values[:-gap]
    near = np.cumsum(near)
    own = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (own[1:] != own[:-1]) | (np.diff(words.row[starts]) != 0)
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate([begin, [len(starts)]]))
    pieces = -(-length // LONGEST_RUN)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = starts[np.repeat(begin, pieces)] + nth * LONGEST_RUN
    count = np.minimum(np.repeat(length, pieces) - nth * LONGEST_RUN, LONGEST_RUN)
    last = first + count + span - 2  # the last m-word run
    # A window may also repeat in the next piece of the same run.
    inner = (near[last] - near[first] > 0) | (np.repeat(pieces, pieces) > 1)
    return first, count, least[first].astype(np.int64), inner


def _places(df: DataFrame, text_col: str, key: list[str]) -> DataFrame:
    """A row per super-k-mer: key of the text, first window, number of windows, minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            words = Words(part.column(text_col))
            first, count, least, inner = runs_of(words, WINDOW, MINIMISER)
            row = words.row[first]
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(pa.array(row)) for c in key]
                + [pa.array((first - words.first[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
                   pa.array(least), pa.array(inner.astype(np.int32))],
                names=[*_KEY, "first", "n", "least", "inner"],
            )

    return df.select(*[quoted(c) for c in (*key, text_col)]).mapInArrow(run, "_a bigint, _b bigint, first int, n int, least bigint, inner int")


def _id_of(packed: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "little", signed=True)


def _packing(batches: Iterator[pa.RecordBatch], text_col: str, key: list[str], runs_col: str, places: bool) -> Iterator[pa.RecordBatch]:
    """From texts with their list of super-k-mers: the packed strings, equal ones of a batch once with
    their number; or, with ``places``, where each string stands in its text."""
    for part in slices(batches, text_col):
        words = Words(part.column(text_col))
        text, start, end = words.joined()
        listed = part.column(runs_col)
        row = np.repeat(np.arange(part.num_rows), np.diff(listed.offsets.to_numpy()))
        runs = listed.flatten()
        at = runs.field("first").to_numpy().astype(np.int64)
        n, least, hot = (runs.field(f).to_numpy(zero_copy_only=False) for f in ("n", "least", "hot"))
        # Windows of hot minimisers go one by one, by a hash of their own.
        each = np.where(hot, n, 1)
        which = np.repeat(np.arange(len(n)), each)
        shift = np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
        at, row, n = at[which] + shift, row[which], np.where(hot, 1, n)[which]
        first = words.first[row] + at
        last = first + n + WINDOW - 2
        low, high = start[first], end[last]
        bucket = least[which].copy()
        single = hot[which]
        if single.any():
            data = np.frombuffer(text, np.uint8)
            bucket[single] = mix(hash_ranges(data, low[single], high[single])).astype(np.int64)
        strings = [text[i:j] for i, j in zip(low.tolist(), high.tolist())]
        if places:
            ids = [_id_of(s) for s in strings]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(ids, pa.int64())] + [part.column(c).take(pa.array(row)) for c in key] + [pa.array(at.astype(np.int32))],
                names=["bucket", "packed_id", *_KEY, "first"],
            )
        else:
            seen: dict[bytes, list[int]] = {}
            for i, s in enumerate(strings):
                if s in seen:
                    seen[s][1] += 1
                else:
                    seen[s] = [i, 1]
            kept = [v[0] for v in seen.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[kept]), pa.array(list(seen), pa.binary()), pa.array([v[1] for v in seen.values()], pa.int64())],
                names=["bucket", "packed", "copies"],
            )


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Gather sorted rows into groups that hold only whole buckets."""
    bucket: list[np.ndarray] = []
    packed: list[bytes] = []
    copies: list[np.ndarray] = []
    weight = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        b, p, c = batch.column("bucket").to_numpy(), batch.column("packed").to_pylist(), batch.column("copies").to_numpy()
        bucket.append(b)
        packed += p
        copies.append(c)
        weight += batch.column("packed").nbytes
        if weight >= GROUP_BYTES:
            b, c = np.concatenate(bucket), np.concatenate(copies)
            cut = int(np.searchsorted(b, b[-1]))
            if cut:
                yield b[:cut], packed[:cut], c[:cut]
            bucket, packed, copies = [b[cut:]], packed[cut:], [c[cut:]]
            weight = sum(map(len, packed)) if cut else 0
    if packed:
        yield np.concatenate(bucket), packed, np.concatenate(copies)


def repeated_windows(packed: list[bytes], copies: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of packed strings (each once) and their numbers: string and offset of each window that occurs at
    least twice. Windows are sorted by hash, and equal neighbours are compared byte by byte."""
    words = Words(pa.array(packed, pa.binary()).cast(pa.string()))
    starts = words.fits(size)
    if not len(starts):
        return starts, starts
    key = grams(words.hashes(), size)[starts]
    order = np.argsort(key, kind="stable")
    starts, key = starts[order], key[order]
    low, high = words.start[starts], words.end[starts + size - 1]
    data = words.data.tobytes()
    equal = np.zeros(len(key), bool)
    pairs = np.flatnonzero(key[1:] == key[:-1]) + 1
    equal[pairs] = [data[a:b] == data[c:d] for a, b, c, d in zip(*(x.tolist() for x in (low[pairs], high[pairs], low[pairs - 1], high[pairs - 1])))]
    group = np.cumsum(~equal) - 1
    total = np.bincount(group, weights=copies[words.row[starts]])
    twice = total[group] >= 2
    starts = np.sort(starts[twice])
    return words.row[starts], starts - words.first[words.row[starts]]


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket: id of each packed string with repeated windows, and their ranges."""
    for bucket, packed, copies in _whole_buckets(batches):
        total: dict[bytes, int] = {}
        home: dict[bytes, int] = {}
        for b, p, c in zip(bucket.tolist(), packed, copies.tolist()):
            total[p] = total.get(p, 0) + c
            home[p] = b
        strings = list(total)
        which, at = repeated_windows(strings, np.array(list(total.values())), WINDOW)
        if not len(which):
            continue
        new = np.ones(len(which), bool)
        new[1:] = (np.diff(which) != 0) | (np.diff(at) != 1)
        begin = np.flatnonzero(new)
        stop = np.concatenate([begin[1:], [len(which)]]) - 1
        owner = which[begin].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([home[strings[i]] for i in owner], pa.int64()), pa.array([_id_of(strings[i]) for i in owner], pa.int64()),
             pa.array(at[begin].astype(np.int32)), pa.array((at[stop] - at[begin] + WINDOW).astype(np.int32))],
            names=["bucket", "packed_id", "skip", "length"],
        )


def repeated_ranges(keyed: DataFrame, text_col: str, key: list[str]) -> DataFrame:
    """Per text with repeated windows: its key (_a, _b) and the word ranges (``at``, ``length``) to remove."""
    places = _places(keyed, text_col, key)
    counts = places.groupBy("least").agg((F.count(F.lit(1)) + F.max("inner")).alias("_n")).where("_n > 1")
    open_runs = places.join(counts, "least").select(
        *_KEY, F.struct("first", "n", "least", (F.col("_n") > HOT).alias("hot")).alias("run")
    )
    # A text's own runs: bounded by the text. Rows that repeat a key have the same runs, which sets hold once
    # from the first partial sum on; the same goes for the ranges below.
    runs = fresh(keyed, "_runs")
    listed = open_runs.groupBy(*_KEY).agg(F.collect_set("run").alias(runs))
    loaded = keyed.join(_renamed(listed, key), key)
    packed = loaded.mapInArrow(
        lambda b: _packing(b, text_col, key, runs, False), "bucket bigint, packed binary, copies bigint"
    )
    spots = loaded.mapInArrow(
        lambda b: _packing(b, text_col, key, runs, True), "bucket bigint, packed_id bigint, _a bigint, _b bigint, first int"
    )
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = packed.repartition(n, "bucket").sortWithinPartitions("bucket")
    verdicts = ordered.mapInArrow(_verdicts, "bucket bigint, packed_id bigint, skip int, length int")
    ranges = spots.join(verdicts, ["bucket", "packed_id"]).select(
        *_KEY, F.struct((F.col("first") + F.col("skip")).alias("at"), "length").alias("range")
    )
    return ranges.groupBy(*_KEY).agg(F.collect_set("range").alias("ranges"))


def _renamed(df: DataFrame, key: list[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(_KEY, key)))


def _strip(words: Words, listed: pa.ListArray) -> np.ndarray:
    """Which words of a column lie in the ranges listed for their row."""
    listed = listed.fill_null([]) if listed.null_count else listed
    row = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
    ranges = listed.flatten()
    if not len(ranges):
        return np.zeros(len(words), bool)
    first = words.first[row] + ranges.field("at").to_numpy()
    return cover(first, ranges.field("length").to_numpy(), len(words))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str | None = None) -> DataFrame:
    """Remove every word that a repeated window covers. The text column becomes the kept words joined by
    single spaces (a text that loses nothing stays as it is); counts are added as the struct ``out`` (n_words,
    n_removed, kept: the joined kept words) if a name is given. A null text stays null."""
    names = df.columns
    keyed, key = _keyed(df, id_col, text_col)
    range_name = fresh(keyed, "_ranges")
    listed = _renamed(repeated_ranges(keyed, text_col, key), key).withColumnRenamed("ranges", range_name)
    joined = keyed.join(listed, key, "left").select(*[quoted(c) for c in names], *key, range_name)
    added = {f: fresh(joined, f) for f in ("_words", "_removed", "_kept")}
    kinds = ["bigint", "bigint", "string"]
    schema = StructType(
        [*keyed.select(*[quoted(c) for c in names]).schema, *StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in zip(added.values(), kinds)))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            words = Words(part.column(text_col))
            gone = _strip(words, part.column(range_name))
            removed = np.bincount(words.row[gone], minlength=part.num_rows)
            kept = kept_texts(words, ~gone)
            columns = [part.column(i) for i in range(len(names))]
            columns += [pa.array(words.count, pa.int64()), pa.array(removed, pa.int64()), kept]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added.values()])

    done = joined.mapInArrow(run, schema)
    changed = F.when(F.col(added["_removed"]) > 0, F.col(added["_kept"])).otherwise(quoted(text_col))
    result = [changed.alias(c) if c == text_col else quoted(c) for c in names]
    if out:
        fields = zip(added.values(), ("n_words", "n_removed", "kept"))
        result.append(F.struct(*[F.col(a).alias(b) for a, b in fields]).alias(out))
    return done.select(*result)


def kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row joined by single spaces: runs of kept words are copied in one piece."""
    text, start, end = words.joined()
    kept = np.flatnonzero(keep)
    pieces: list[list[bytes]] = [[] for _ in words.count]
    if len(kept):
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) != 1) | (np.diff(words.row[kept]) != 0)
        begin = np.flatnonzero(new)
        first, last = kept[begin], kept[np.concatenate([begin[1:], [len(kept)]]) - 1]
        for row, i, j in zip(words.row[first].tolist(), start[first].tolist(), end[last].tolist()):
            pieces[row].append(text[i:j])
    return pa.array([b" ".join(p) for p in pieces], pa.binary()).cast(pa.string())
