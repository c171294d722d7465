"""Near-duplicates by MinHash bands whose candidates are checked with odd sketches, then exactly.

A text's set is its distinct word shingles, lower-cased (A-Z). Two texts are linked when the
intersection of their sets holds at least 80 percent of the union; linked texts form components.

* MinHash samples of each set make ``BANDS`` bucket keys, and ``HASHES`` of them are folded into an odd sketch: a
  bitmap whose bits hold the parity of the samples that fall on them. The exclusive or of two sketches
  has few ones when the sets are alike, which estimates high similarities closely. Sketches only rule
  out pairs well below the threshold (``SURE_BELOW``, over four standard deviations away); the others are
  confirmed on the full sets.
* Texts with equal sets are one vertex, so exact copies cost a row each and no pairs.
* In a bucket every vertex is first compared with the smallest one only. Buckets that then still hold
  several components get new leaders for ``ROUNDS`` rounds. At last pairs across components are checked,
  so that no link of the bucket is lost; members of one component are never paired again. Shingles that
  at most ``RARE`` of the remaining vertices have are rare. Two sets that share no rare shingle have at most
  the smaller number of frequent ones in common; only if that could be enough are they a pair. All
  others that could be linked meet at a rare shingle, whose list is short. So the many versions of one
  text, each too far from the others, make no pairs.
* The chance that a pair at the threshold shares no bucket is (1 - 0.8**4)**32, about 5e-8.

Cases: a null or wordless text has an empty set and is linked with nothing; a text shorter than a
shingle has one, the whole sequence. Rows that repeat an id count as one, and one of their
texts (that with the smallest hash) stands for all. A row without an id is linked with nothing and kept. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from speechset.llm.frames import fresh, quoted, slices, texts
from speechset.llm.words import Words, grams, mix
from speechset.operators.positions import dense_positions
from speechset.session import materialize

SHINGLE = 4
PERCENT = 80
BANDS, ROWS = 32, 4
HASHES = 512  # samples in a sketch; the first BANDS * ROWS make the bucket keys
SKETCH_WORDS = 16  # of 64 bits
SURE_BELOW = 0.71
ROUNDS = 2
RARE = 64
SALT_ROWS = 256  # members that are compared with one copy of their leader's text

_random = np.random.Generator(np.random.PCG64(7))
_ODD = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_SIGNATURE = "doc_id bigint, th bigint, n int, s1 bigint, s2 bigint, bands array<bigint>, sketch array<bigint>"


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all rows, sorted inside each row, and the offset of each row."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    starts = words.fits(size)
    keys, row = grams(hashes, size)[starts], words.row[starts]
    for n in range(1, size):  # a shorter text is one shingle of another length
        short = np.flatnonzero(words.count == n)
        keys = np.concatenate([keys, grams(hashes, n)[words.first[short]] ^ np.uint64(n)])
        row = np.concatenate([row, short])
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    keys, row = keys[new], row[new]
    return keys, np.searchsorted(row, np.arange(len(words.count) + 1))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per row: set size, two sums that identify the set, bucket keys and odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            keys, offsets = shingle_sets(part.column("text"), size)
            n = np.diff(offsets)
            full = np.flatnonzero(n)
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            bands = np.zeros((len(n), BANDS), np.uint64)
            sketch = np.zeros((len(n), SKETCH_WORDS), np.uint64)
            if len(full):
                at = offsets[full]
                s1[full] = np.add.reduceat(mix(keys), at)
                s2[full] = np.add.reduceat(mix(keys ^ _FLIP[0]), at)
                for i in range(HASHES):
                    least = mix(np.minimum.reduceat((keys ^ _FLIP[i]) * _ODD[i], at) ^ _FLIP[-1 - i])
                    if i < BANDS * ROWS:
                        bands[full, i // ROWS] = mix(bands[full, i // ROWS] + least)
                    bit = least % np.uint64(64 * SKETCH_WORDS)
                    sketch[full, (bit >> np.uint64(6)).astype(int)] ^= np.uint64(1) << (bit & np.uint64(63))
            lists = lambda x: pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * x.shape[1], pa.array(x.astype(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(n.astype(np.int32)), pa.array(s1.astype(np.int64)), pa.array(s2.astype(np.int64)), lists(bands), lists(sketch)],
                names=["doc_id", "th", "n", "s1", "s2", "bands", "sketch"],
            )

    return docs.mapInArrow(run, _SIGNATURE)


# The most ones in the exclusive or of two sketches whose estimate is at least SURE_BELOW: the estimate falls as they grow.
MOST_ONES = int(32 * SKETCH_WORDS * (1 - math.exp(4 * HASHES * (SURE_BELOW - 1) / (64 * SKETCH_WORDS))))


def may_be_alike(a: Column, b: Column) -> Column:
    """Whether the estimate from two odd sketches reaches ``SURE_BELOW``."""
    ones = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return ones <= MOST_ONES


def sizes_allow(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _linked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by leader, each leader's own text first: the members that are linked with it."""
    leader, leader_set = None, np.zeros(0, np.uint64)
    for part in slices(batches, limit=1 << 20):
        keys, offsets = shingle_sets(part.column("text"), size)
        found: list[tuple[int, int]] = []
        ids = zip(part.column("leader").to_pylist(), part.column("member").to_pylist())
        for i, (lead, member) in enumerate(ids):
            own = keys[offsets[i] : offsets[i + 1]]
            if member is None:
                leader, leader_set = lead, own.copy()
                continue
            if lead != leader:
                raise RuntimeError("a member came without its leader")
            place = np.searchsorted(leader_set, own)
            both = int((leader_set[np.minimum(place, len(leader_set) - 1)] == own).sum()) if len(leader_set) else 0
            if both and 100 * both >= PERCENT * (len(own) + len(leader_set) - both):
                found.append((lead, member))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"]
        )


def confirm(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Those of ``pairs`` (leader, member) whose full sets are alike enough, as (a, b). Members meet their
    leader's text in salted groups of about ``SALT_ROWS``, however many they are."""
    counted = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("_n"))
    salts = counted.select("leader", F.ceil(F.col("_n") / SALT_ROWS).cast("int").alias("_salts"))
    members = pairs.join(salts, "leader").select(
        "leader", F.pmod(F.xxhash64("member"), F.col("_salts")).cast("int").alias("salt"), F.col("member")
    )
    leaders = salts.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("member")
    )
    wanted = members.unionByName(leaders).withColumn("doc_id", F.coalesce("member", "leader"))
    rows = wanted.join(docs, "doc_id").select("leader", "salt", "member", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "leader", "salt").sortWithinPartitions("leader", "salt", F.col("member").asc_nulls_first())
    return ordered.mapInArrow(lambda b: _linked(b, size), "a bigint, b bigint")


def merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (v, c) after joining the components that ``edges`` (a, b) connect: smallest labels spread,
    and each label then takes the label of its label, so long chains close in few passes."""
    at = lambda x: labels.select(F.col("v").alias(x), F.col("c").alias(f"c{x}"))
    between = edges.join(at("a"), "a").join(at("b"), "b").where("ca <> cb")
    # Each edge in both directions, and each end with itself, so that a label's own value is among its neighbours'.
    ends = [F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("ca", "cb"), ("cb", "ca"), ("ca", "ca"), ("cb", "cb"))]
    between = materialize(between.select(F.explode(F.array(*ends)).alias("e")).select("e.*").distinct(), "between")
    tree = materialize(between.groupBy("x").agg(F.min("y").alias("c")), "tree")
    while True:
        around = between.join(tree.select(F.col("x").alias("y"), "c"), "y").groupBy("x")
        nearer = around.agg(F.min("c").alias("c"), F.max(F.when(F.col("x") == F.col("y"), F.col("c"))).alias("before"))
        jump = nearer.join(tree.select(F.col("x").alias("c"), F.col("c").alias("far")), "c", "left")
        after = materialize(jump.select("x", F.least("c", F.coalesce("far", "c")).alias("c"), "before"), "tree")
        tree = after.select("x", "c")
        if not after.where("c <> before").limit(1).count():
            break
    found = labels.join(tree.select(F.col("x").alias("c"), F.col("c").alias("to")), "c", "left")
    return materialize(found.select("v", F.coalesce("to", "c").alias("c")), "labels")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """A row per id: doc_id, n_shingles, component_id, kept (its component's smallest id)."""
    docs = texts(df, id_col, text_col).withColumn("th", F.xxhash64("text"))
    signed = signatures(docs.where("doc_id IS NOT NULL"), size)
    whole = F.struct("th", "n", "s1", "s2", "bands", "sketch")
    one = materialize(signed.groupBy("doc_id").agg(F.min(whole).alias("s")).select("doc_id", "s.*"), "signatures")
    equal = ["n", "s1", "s2"]
    first = one.where("n > 0").groupBy(*equal).agg(F.min("doc_id").alias("v"))
    members = materialize(one.where("n > 0").select("doc_id", *equal).join(first, equal).select("doc_id", "v"), "members")
    vertices = one.join(members.where("doc_id = v").select("doc_id"), "doc_id")
    buckets = vertices.select(F.col("doc_id").alias("v"), "n", F.posexplode("bands").alias("band", "key")).drop("band")
    # Buckets of one vertex say nothing: only the others are kept, with their smallest vertex.
    heads = buckets.groupBy("key").agg(F.min(F.struct("v", "n")).alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1")
    crowded = materialize(buckets.join(heads, "key").select("key", "v", "n", "head"), "buckets")
    known = materialize(vertices.join(crowded.select(F.col("v").alias("doc_id")).distinct(), "doc_id").select("doc_id", "th", "n", "sketch", "bands"), "known")
    loaded = materialize(_texts_of(docs, known), "texts")
    labels = materialize(known.select(F.col("doc_id").alias("v"), F.col("doc_id").alias("c")), "labels")
    tested = None
    for turn in range(ROUNDS + 2):
        if turn == 0:
            raw = crowded.where("v <> head.v").select(F.col("head.v").alias("leader"), F.col("v").alias("member"))
        else:
            here = crowded.select("key", "v", "n").join(labels, "v")
            mixed = here.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
            here = here.join(mixed.select("key", "lo"), "key")
            if turn <= ROUNDS:
                # A new leader from the first component of the bucket, by a hash that changes each turn.
                chief = here.where("c = lo").groupBy("key").agg(F.min_by("v", F.xxhash64("v", F.lit(turn))).alias("leader"))
                raw = here.where("c <> lo").join(chief, "key").select("leader", F.col("v").alias("member"))
            else:
                left = materialize(here.select("v", "c").distinct(), "left")
                common = _common_shingles(left, loaded, size)
                raw = _across(here, known, common).unionByName(_sharing(common, known))
        pairs = raw.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["leader", "member"], "left_anti")
        side = lambda x: known.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
        alike = pairs.join(side("leader"), "leader").join(side("member"), "member").where(
            sizes_allow(F.col("n_leader"), F.col("n_member")) & may_be_alike(F.col("s_leader"), F.col("s_member"))
        )
        likely = materialize(alike.select("leader", "member"), "likely")
        if turn and not likely.limit(1).count():
            continue
        labels = merge(labels, confirm(likely, loaded, size))
        tested = likely if tested is None else tested.unionByName(likely)
    labelled = members.join(labels, "v", "left").select("doc_id", F.coalesce("c", "v").alias("c"))
    # A component's smallest id: its smallest vertex, as a vertex is the smallest id of its set.
    result = one.select("doc_id", "n").join(labelled, "doc_id", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id")
    )
    nameless = signatures(docs.where("doc_id IS NULL"), size).select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id")
    )
    return result.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _common_shingles(left: DataFrame, loaded: DataFrame, size: int) -> DataFrame:
    """(v, c, h, found): the shingles that several vertices have, with the number of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            keys, offsets = shingle_sets(part.column("text"), size)
            row = pa.array(np.repeat(np.arange(part.num_rows), np.diff(offsets)))
            yield pa.RecordBatch.from_arrays(
                [part.column("v").take(row), part.column("c").take(row), pa.array(keys.astype(np.int64))], names=["v", "c", "h"]
            )

    texts_left = left.join(loaded.select(F.col("doc_id").alias("v"), "text"), "v").select("v", "c", "text")
    every = texts_left.mapInArrow(run, "v bigint, c bigint, h bigint")
    counts = every.groupBy("h").agg(F.count(F.lit(1)).alias("found")).where("found > 1")
    return materialize(every.join(counts, "h").select("v", "c", "h", "found"), "common")


def _sharing(common: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs across components that share a rare shingle, and whose sketches are alike.

    Shingles are in order of how many vertices have them. The first one that a linked pair has in common comes so early in
    either set that what lies after it is still enough to reach the threshold: among the first n - ceil(0.8 n) + 1 of n. Shingles that no
    other vertex has come before all others, so of most vertices no shingle is left to meet by."""
    n_common = common.groupBy("v").agg(F.count(F.lit(1)).alias("n_common"))
    n = F.col("n").cast("bigint")
    early = n - F.ceil(n * PERCENT / 100) + 1 - (n - F.col("n_common"))
    sized = known.select(F.col("doc_id").alias("v"), "n", "sketch").join(n_common, "v").withColumn("early", early).where("early > 0")
    place = F.row_number().over(Window.partitionBy("v").orderBy("found", "h"))  # the shingles of one text
    rare = common.where(F.col("found") <= RARE).join(sized.select("v", "early"), "v").withColumn("place", place).where("place <= early")
    shared = rare.select("v", "c", "h").join(sized.select("v", "n", "sketch"), "v")
    other = shared.select(F.col("h").alias("k"), F.col("v").alias("leader"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("sketch").alias("s"))
    alike = (F.col("c") < F.col("d")) & sizes_allow(F.col("n"), F.col("m")) & may_be_alike(F.col("sketch"), F.col("s"))
    return shared.join(other, (F.col("h") == F.col("k")) & alike).select("leader", F.col("v").alias("member"))


def _across(here: DataFrame, known: DataFrame, common: DataFrame) -> DataFrame:
    """Pairs of one bucket and two components that could be linked by their frequent shingles alone. All is
    compared in the join itself, which gives only pairs that are alike, and each in the first band it shares."""
    frequent = common.where(F.col("found") > RARE).groupBy(F.col("v").alias("doc_id")).agg(F.count(F.lit(1)).alias("frequent"))
    sized = known.join(frequent, "doc_id").select(F.col("doc_id").alias("v"), "n", "sketch", "bands", "frequent")
    full = here.select("key", "v", "c").join(sized, "v")
    other = full.select(F.col("key").alias("k"), F.col("v").alias("leader"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("sketch").alias("s"), F.col("bands").alias("b"), F.col("frequent").alias("f"))
    shared = F.array_position(F.zip_with("bands", "b", lambda x, y: x == y), F.lit(True))
    alike = (
        (F.col("c") < F.col("d"))
        & sizes_allow(F.col("n"), F.col("m"))
        & ((100 + PERCENT) * F.least("frequent", "f") >= PERCENT * (F.col("n") + F.col("m")))
        & may_be_alike(F.col("sketch"), F.col("s"))
        & (F.get("bands", shared.cast("int") - 1) == F.col("key"))
    )
    return full.join(other, (F.col("key") == F.col("k")) & alike).select("leader", F.col("v").alias("member"))


def _texts_of(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The texts that may need checking, each once."""
    found = docs.join(known.select("doc_id", "th"), ["doc_id", "th"])
    return found.groupBy("doc_id").agg(F.max("text").alias("text"))


def first_of_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, once: bool = False) -> DataFrame:
    """The rows of ``df`` without those that are near-duplicates of a text with a smaller id. With ``once``,
    one row of each id that stays, and of the rows without an id one of each set that no row with an id has; those with an
    empty set all stay. Different texts under one id are documents of their own then: the one with the smallest hash stands for the
    id, the others come after all ids, and each stays unless it is a near-duplicate of one before it."""
    gone_id, again_id = fresh(df, "_gone"), fresh(df, "_again")
    own, text = quoted(id_col).cast("bigint"), quoted(text_col).cast("string")
    if not once:
        gone = near_duplicates(df, id_col, text_col, size).where("NOT kept").select(F.col("doc_id").alias(gone_id))
        return df.join(gone, own == F.col(gone_id), "left_anti")
    th = F.xxhash64(text)
    again = df.where(own.isNotNull()).groupBy(own.alias(again_id)).agg(F.count(F.lit(1)).alias("_rows"), F.min(th).alias("_first"), F.max(th).alias("_last"))
    again = materialize(again.where("_rows > 1").select(again_id, "_first", "_last"), "again")
    others = _other_texts(df.where(own.isNotNull()).select(own.alias("i"), th.alias("th")), again, again_id)
    if others is None:
        gone = near_duplicates(df, id_col, text_col, size)
    else:
        named = df.where(own.isNotNull()).select(own.alias("i"), th.alias("th"), text.alias("text")).join(others, ["i", "th"], "left")
        gone = near_duplicates(named.select(F.coalesce("other", "i").alias("doc_id"), "text"), size=size)
    gone = materialize(gone.where("NOT kept").select(F.col("doc_id").alias(gone_id)), "gone")
    rows = df.where(own.isNotNull()).join(gone, own == F.col(gone_id), "left_anti")
    many = rows.join(again, own == F.col(again_id), "left_semi")
    result = rows.join(again, own == F.col(again_id), "left_anti").unionByName(_one_of_each(many, df, text_col, own))
    if others is not None:
        left = others.join(gone, F.col("other") == F.col(gone_id), "left_anti")
        names = {c: fresh(df, f"_o{c}") for c in ("i", "th", "other")}
        left = left.select(*[F.col(c).alias(n) for c, n in names.items()])
        own_rows = df.join(left, (own == F.col(names["i"])) & (th == F.col(names["th"])))
        result = result.unionByName(_one_of_each(own_rows, df, text_col, F.col(names["other"])))
    nameless = df.where(own.isNull())
    if not nameless.limit(1).count():
        return result
    keys = [fresh(df, k) for k in ("_n", "_s1", "_s2")]
    taken = _keyed(df.where(own.isNotNull()).select(quoted(text_col).alias("text")), "text", ["_n", "_s1", "_s2"], size).drop("text").distinct()
    keyed = _keyed(nameless, text_col, keys, size)
    theirs = [fresh(df, f"_t{i}") for i in range(3)]
    same = [F.col(k) == F.col(t) for k, t in zip(keys, theirs)]
    free = keyed.where(F.col(keys[0]) > 0).join(taken.toDF(*theirs), same, "left_anti")
    wordless = keyed.where(F.col(keys[0]) == 0).select(*[quoted(c) for c in df.columns])
    return result.unionByName(wordless).unionByName(_one_of_each(free, df, text_col, *[F.col(k) for k in keys]))


def _other_texts(texts_by_id: DataFrame, again: DataFrame, again_id: str) -> DataFrame | None:
    """Texts that do not stand for their id, each with a number of its own above all ids: i, th, other. None if there are none."""
    several = again.where("_first <> _last").select(F.col(again_id).alias("i"), "_first")
    if not several.limit(1).count():
        return None
    pairs = texts_by_id.join(several, "i").where("th <> _first").select("i", "th").distinct()
    last = texts_by_id.agg(F.max("i")).first()[0]
    placed = dense_positions(pairs, ["i", "th"])
    return materialize(placed.select("i", "th", (F.col("pos") + (last + 1)).alias("other")), "others")


def _one_of_each(rows: DataFrame, df: DataFrame, text_col: str, *keys: Column) -> DataFrame:
    """One row of each key, with the columns of ``df``: by the hash of its text, then of all that can be hashed.
    Each task passes on one row a key, so no group is gathered."""
    hashed = [quoted(f.name) for f in df.schema if not re.search("map<|variant", f.dataType.simpleString())]
    order = F.struct(F.xxhash64(quoted(text_col).cast("string")), F.xxhash64(*hashed))
    whole = F.struct(*[quoted(c) for c in df.columns])
    found = rows.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(whole, order).alias("_row"))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def _keyed(df: DataFrame, text_col: str, keys: list[str], size: int) -> DataFrame:
    """Add the three numbers that identify the set of each row's text; rows stay where they are."""
    text, names = fresh(df, "_text"), list(df.columns)
    kinds = [StructField(k, LongType()) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, limit=1 << 20):
            found, offsets = shingle_sets(part.column(text), size)
            n = np.diff(offsets)
            sums = np.zeros((2, len(n)), np.uint64)
            full = np.flatnonzero(n)
            if len(full):
                sums[0, full] = np.add.reduceat(mix(found), offsets[full])
                sums[1, full] = np.add.reduceat(mix(found ^ _FLIP[0]), offsets[full])
            columns = [part.column(i) for i in range(len(names))] + [pa.array(x.astype(np.int64)) for x in (n, *sums)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *keys])

    return df.withColumn(text, quoted(text_col).cast("string")).mapInArrow(run, StructType([*df.schema, *kinds]))
