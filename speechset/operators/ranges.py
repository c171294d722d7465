"""Overlapping ranges made disjoint by a distributed sweep: at each position the first range wins.

The distinct edges of all ranges are numbered in order and cut into pieces of ``PIECE`` edges. A range is then a part of
its first piece, a part of its last one, and all pieces between. Parts that are equal inside a piece are one, so a piece
holds a bounded number of them however many ranges start, end or are open there. What is open over whole pieces is not carried from
piece to piece: a run of pieces is two windows of 1, 2, 4 … pieces that may overlap, each window keeps its best range and is a few
aligned blocks, and a piece asks the blocks above it. There are at most as many windows as pieces times levels, however many ranges. So neither very long nor very many nested ranges make a group grow.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.operators.positions import dense_positions
from speechset.session import materialize

PIECE = 512

_SEGMENT = "split string, lo bigint, hi bigint, num int, name string"


def first_wins(ranges: DataFrame, keys: Sequence[str] = ("map_order", "num", "name")) -> DataFrame:
    """``split, lo, hi, num, name`` without overlaps from inclusive ranges ``split, lo, hi, num, name, map_order``: where several
    hold a position, the one with the smallest ``map_order`` does (then number, then name). Empty ranges and those without a
    split or a bound hold nothing. Neighbours may have the same speaker."""
    clean = ranges.where("split IS NOT NULL AND lo <= hi").select(
        F.col("split").cast("string").alias("split"), F.col("lo").cast("bigint").alias("lo"), (F.col("hi") + 1).cast("bigint").alias("stop"),
        F.struct(F.col("map_order").cast("bigint").alias("map_order"), F.col("num").cast("int").alias("num"), F.col("name").cast("string").alias("name")).alias("w"),
    )
    # Ranges with the same bounds are one.
    rows = materialize(clean.groupBy("split", "lo", "stop").agg(F.min("w").alias("w")), "ranges")
    edges = rows.select("split", F.explode(F.array("lo", "stop")).alias("at")).distinct()
    placed = materialize(dense_positions(edges, "at", ["split"], "rank"), "edges")
    top = placed.agg(F.max("rank")).first()[0] or 0
    levels = F.sequence(F.lit(0), F.lit(max((top // PIECE).bit_length(), 1)))

    first = placed.select("split", F.col("at").alias("lo"), F.col("rank").alias("a"))
    last = placed.select("split", F.col("at").alias("stop"), F.col("rank").alias("b"))
    # Stored: parts and runs both start from it.
    ranked = materialize(rows.join(first, ["split", "lo"]).join(last, ["split", "stop"]).select("split", "w", "a", "b"), "ranked")

    a_piece, b_piece = F.expr(f"a div {PIECE}"), F.expr(f"b div {PIECE}")
    a_rest, b_rest = (F.col(c) % PIECE for c in ("a", "b"))

    def part(piece, start, stop):
        return F.struct(piece.alias("piece"), start.cast("int").alias("a"), stop.cast("int").alias("b"))

    zero, whole = F.lit(0), F.lit(PIECE)
    cut = F.when(a_piece == b_piece, F.array(part(a_piece, a_rest, b_rest))).otherwise(
        F.array(part(a_piece, a_rest, whole), part(b_piece, zero, b_rest))
    )
    # A part that is a whole piece belongs to the run, and one of no edges is none.
    parts = ranked.select("split", "w", F.explode(F.filter(cut, lambda p: (p["a"] < p["b"]) & ~((p["a"] == 0) & (p["b"] == PIECE)))).alias("p"))
    parts = parts.groupBy("split", "p.piece", "p.a", "p.b").agg(F.min("w").alias("w"))

    runs = ranked.select("split", "w", F.expr(f"(a + {PIECE - 1}) div {PIECE}").alias("x"), b_piece.alias("y")).where("x < y")
    runs = _windows(runs)
    at_level = F.transform(levels, lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("x") + F.call_function("shiftleft", F.lit(1).cast("bigint"), k) - 1, k).alias("x"), F.call_function("shiftright", F.col("y"), k).alias("y")))
    blocks = F.flatten(
        F.transform(
            F.filter(at_level, lambda n: n["x"] < n["y"]),
            lambda n: F.filter(
                F.array(
                    F.struct(n["level"].alias("level"), F.when(n["x"] % 2 == 1, n["x"]).alias("block")),
                    F.struct(n["level"].alias("level"), F.when(n["y"] % 2 == 1, n["y"] - 1).alias("block")),
                ),
                lambda m: m["block"].isNotNull(),
            ),
        )
    )
    best = runs.select("split", "w", F.explode(blocks).alias("n")).groupBy("split", "n.level", "n.block").agg(F.min("w").alias("w"))
    pieces = placed.select("split", F.expr(f"rank div {PIECE}").alias("piece")).distinct()
    above = pieces.select("split", "piece", F.explode(levels).alias("level")).withColumn("block", F.call_function("shiftright", F.col("piece"), F.col("level")))
    over = above.join(best, ["split", "level", "block"]).groupBy("split", "piece").agg(F.min("w").alias("w"))
    over = over.select("split", "piece", zero.alias("a"), whole.alias("b"), "w")

    following = placed.select("split", (F.col("rank") - 1).alias("rank"), F.col("at").alias("next"))
    steps = placed.join(following, ["split", "rank"]).select(
        "split", F.expr(f"rank div {PIECE}").alias("piece"), (F.col("rank") % PIECE).cast("int").alias("a"), "at", "next"
    )
    flat = parts.unionByName(over).select("split", "piece", "a", "b", "w.map_order", "w.num", "w.name")
    both = flat.unionByName(steps, allowMissingColumns=True)
    return both.groupBy("split", "piece").applyInArrow(_sweep, _SEGMENT)


def _windows(runs: DataFrame) -> DataFrame:
    """The runs ``split, w, x, y`` (x < y) as windows of a power of two, one row a window with its smallest ``w``: the first
    and the last one of a run cover it, and a minimum may count pieces twice."""
    level = F.length(F.bin(F.col("y") - F.col("x"))) - 1
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_level"))
    ends = runs.withColumn("_level", level).select("split", "w", width.alias("_width"), F.explode(F.array(F.col("x"), F.col("y") - width)).alias("x"))
    best = ends.groupBy("split", "x", "_width").agg(F.min("w").alias("w"))
    return best.select("split", "w", "x", (F.col("x") + F.col("_width")).alias("y"))


def _sweep(table: pa.Table) -> pa.Table:
    """Paint the parts of a piece over its edges, from the last to the first in order."""
    split = table.column("split")[0]
    is_edge = table.column("at").is_valid()
    edges, parts = table.filter(is_edge).sort_by("a"), table.filter(pa.compute.invert(is_edge))
    parts = parts.sort_by([("map_order", "descending"), ("num", "descending"), ("name", "descending")])
    owner = np.full(PIECE, -1)
    for i, (a, b) in enumerate(zip(parts.column("a").to_pylist(), parts.column("b").to_pylist())):
        owner[a:b] = i
    owner = owner[edges.column("a").to_numpy()]
    # Neighbours of one owner are one segment; edges of a piece follow each other without a gap.
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    stops = np.concatenate([starts[1:], [len(owner)]]) if len(owner) else starts
    held = owner[starts] >= 0
    starts, stops = starts[held], stops[held]
    who = parts.take(pa.array(owner[starts], pa.int64()))
    lo = edges.column("at").take(pa.array(starts))
    hi = pa.compute.subtract(edges.column("next").take(pa.array(stops - 1)), 1)
    fields = pa.schema([("split", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("num", pa.int32()), ("name", pa.string())])
    names = pa.array([split.as_py()] * len(starts), pa.string())
    return pa.Table.from_arrays([names, lo, hi, who.column("num"), who.column("name")], schema=fields)
