"""URL filters by a cascade of Bloom filters, in DataFrame functions only.

A rule is a host and the start of a path, such as ``example.com/en/``, with an action. It fits its host and
all subdomains of it, where the URL's path starts with the rule's; of the rules that fit, the longest decides,
and of equally long ones that with the longer host. So the keys a URL could be listed under are ends of its
host, cut before a label, with starts of its path, as far as any rule has that number of labels and that
length of path (its shape).

All such keys of the corpus are the universe. The first filter of a cascade holds the listed keys of the
universe, the second one the other keys that the first takes for listed, the third the listed keys that the
second takes for others, and so on until no key is mistaken. A key of the universe is then listed exactly
if the first filter that lacks it is an even one (counted from the first as 1). One cascade tells rules from
other keys, a second one tells blocking rules from allowing ones. Rows meet the filters as literals: judging
takes neither a join nor a shuffle, and cannot err, since every key asked for is in the universe.

Filters grow with the list, by about 1.44 * log2(keys / listed) bits a rule. Where a cascade would need more than
``MAX_BITS``, keys are dealt into groups by hash with a cascade each, and the rows pass the groups one after the
other, so that a plan never carries more than one group's filters.

Cases: a URL that is null or has no ``://`` has an empty host and path. Of the host only A-Z are lower-cased; a
port or user name is part of it. A URL that no rule fits is allowed. A rule that is given twice counts once; if
it both blocks and allows, it blocks. Null rules are left out; a rule whose action is not ``block`` allows. Rows
stay as they are, repeated ones and those without an id too; other columns stay, and a column whose name is
that of a new one makes the new name longer by underscores only inside the operator. An empty table gives an
empty result, and an empty list allows everything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.llm.frames import fresh, quoted
from speechset.session import materialize, small_table

# Bits of the filters that one plan carries: two megabytes.
MAX_BITS = 1 << 24
WORD = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _host_and_path(text: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(text, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(text, "^[^/?#]*([^?#]*)", 1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, after the first ``://``, and the path up to a query or fragment; both empty without one."""
    at = F.instr(url, "://")
    host, path = _host_and_path(F.when(at > 0, F.substr(url, at + 3)).otherwise(""))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _listed(rules: DataFrame) -> DataFrame:
    """``key, block, n_labels, n_path`` of each rule."""
    host, path = _host_and_path(F.col("rule"))
    parts = rules.where("rule IS NOT NULL").select(host.alias("host"), path.alias("path"), (F.col("action") == "block").alias("block"))
    return parts.groupBy(
        F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("n_labels"), F.char_length("path").alias("n_path")
    ).agg(F.coalesce(F.max("block"), F.lit(False)).alias("block"))


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a URL in the given shapes, the longest first, and of equally long ones the longer host."""
    if not shapes:
        return F.array().cast("array<string>")
    labels = F.split(host, r"\.")
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in shapes])
    fitting = F.filter(each, lambda s: (s["k"] <= F.size(labels)) & (s["p"] <= F.char_length(path)))

    def key(s: Column) -> Column:
        end = F.array_join(F.slice(labels, F.size(labels) - s["k"] + 1, s["k"]), ".")
        return F.struct(
            (F.char_length(end) + s["p"]).alias("size"), s["k"].alias("k"), F.concat(end, F.substr(path, F.lit(1), s["p"])).alias("key")
        )

    return F.transform(F.reverse(F.array_sort(F.transform(fitting, key))), lambda s: s["key"])


class Filter:
    """A Bloom filter of a set of keys, made by one aggregation; ``holds`` is an expression over a literal."""

    def __init__(self, keys: DataFrame, n: int, share: float, level: int):
        self.level = level
        self.hashes = max(1, round(-math.log2(share)))
        self.bits = max(WORD, math.ceil(n * self.hashes / math.log(2) / WORD) * WORD)
        places = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("at"))
        words = (
            places.groupBy(F.expr(f"at div {WORD}").alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD).cast("int"))).alias("bits"))
            .collect()  # at most ``bits`` / 64 rows
        )
        filled = ["0"] * (self.bits // WORD)
        for row in words:
            filled[row["word"]] = str(row["bits"])
        self._words = ",".join(filled)

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self._words), ",").cast("array<bigint>")  # folded into one literal
        found = F.lit(True)
        for at in self._places(key):
            word = F.element_at(words, (F.floor(at / WORD) + 1).cast("int"))
            found = found & (F.call_function("shiftright", word, (at % WORD).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return found


class Cascade:
    """Exact membership for the keys it was built over: ``keys`` with ``key`` and a boolean ``listed``."""

    def __init__(self, keys: DataFrame, first_level: int = 0):
        sizes = {row["listed"]: row["n"] for row in keys.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
        inside, outside = keys.where("listed").select("key"), keys.where("NOT listed").select("key")
        n_in, n_out = sizes.get(True, 0), sizes.get(False, 0)
        self.levels: list[Filter] = []
        # The first filter may mistake as many keys as are listed, and later ones half of what is left.
        share = min(0.5, n_in * math.sqrt(0.5) / n_out) if n_out else 0.5
        while n_in:
            level = Filter(inside, n_in, share, first_level + len(self.levels))
            self.levels.append(level)
            if not n_out:
                break
            mistaken = materialize(outside.where(level.holds(F.col("key"))), "mistaken")
            inside, n_in, outside, n_out, share = mistaken, mistaken.count(), inside, n_in, 0.5

    def holds(self, key: Column) -> Column:
        held = F.lit(False)
        for level in reversed(self.levels):
            held = level.holds(key) & ~held
        return held

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)


def _group(key: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("group")), F.lit(groups))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, url_col: str = "url", max_bits: int = MAX_BITS
) -> DataFrame:
    """Add a struct column ``judged`` with ``host, path, rule, verdict`` to every row: the rule that decides (null
    where none fits), and ``block`` or ``allow``. ``rules`` has ``rule`` and ``action``."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = small_table(spark, list(rules), "rule string, action string")
    listed = materialize(_listed(rules), "rules")
    # Shapes are as many as numbers of labels and lengths of path that rules have, however long the list.
    shapes = sorted((r["n_labels"], r["n_path"]) for r in listed.select("n_labels", "n_path").distinct().collect())
    host, path = host_and_path(quoted(url_col))
    candidates = _keys(host, path, shapes)
    seen = pages.select(F.explode(candidates).alias("key")).select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed"), F.lit(False).alias("block"))
    both = seen.unionByName(listed.select("key", F.lit(False).alias("seen"), F.lit(True).alias("listed"), "block"))
    universe = materialize(
        both.groupBy("key").agg(F.max("seen").alias("seen"), F.max("listed").alias("listed"), F.max("block").alias("block")).where("seen").drop("seen"),
        "universe",
    )
    n_keys, n_listed = universe.agg(F.count(F.lit(1)), F.count_if(F.col("listed"))).first()
    expected = n_listed * (4 + 1.44 * math.log2(max(2.0, n_keys / max(n_listed, 1))))
    groups = max(1, math.ceil(expected / max_bits))

    best, out = fresh(pages, "_best"), fresh(pages, "judged")
    kind = "struct<rule:string,block:boolean>"
    result = pages.withColumn(best, F.lit(None).cast(kind))
    for group in range(groups):
        own = universe.where(_group(F.col("key"), groups) == group) if groups > 1 else universe
        is_rule = Cascade(own.select("key", "listed"))
        is_block = Cascade(own.where("listed").select("key", F.col("block").alias("listed")), first_level=1000)
        mine = F.filter(candidates, lambda k: _group(k, groups) == group) if groups > 1 else candidates
        hit = F.get(F.filter(mine, lambda k: is_rule.holds(k)), F.lit(0))
        found = F.when(hit.isNotNull(), F.struct(hit.alias("rule"), is_block.holds(hit).alias("block")))
        if group:
            # Of two groups' rules the longer one counts, by the order of the keys themselves.
            place = F.array_position(candidates, F.col(best)["rule"])
            found = F.when(F.col(best).isNull() | (F.array_position(candidates, hit) < place), found)
        result = result.withColumn(best, F.coalesce(found.cast(kind), F.col(best)))
        if groups > 1:
            result = materialize(result, "judged")
    verdict = F.when(F.col(best)["block"], "block").otherwise("allow")
    judged = F.struct(host.alias("host"), path.alias("path"), F.col(best)["rule"].alias("rule"), verdict.alias("verdict"))
    return result.withColumn(out, judged).drop(best)
