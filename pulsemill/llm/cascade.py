"""Address filters: prefix rules, and a cascade of Bloom filters for a list of keys.

Level 1 encodes the listed keys. Level 2 encodes those unlisted keys of the universe that level 1 lets
through by mistake, level 3 the listed keys that level 2 lets through, and so on until a level lets no
wrong key through. A key that first fails at an even level is listed, one that first fails at an odd level
is not, so the cascade is exact for every key of the universe: `judged` looks bits up and joins no list.

Keys are dealt to shards by hash; a shard has its own cascade, whose levels are bitmaps of SEGMENT bits,
built by Spark's bitmap aggregate. Shards are counted from the list and the universe, so that about as many
wrong keys pass a level as it holds. Up to FLAT_BYTES the bits of a level travel as one constant inside the
expression. Beyond that the rows take the bitmaps of their own shard, hot shards apart.

Nulls and ties: a null key is in no list and is never listed. Repeated keys count once. A key in both
frames is listed. Keys outside the universe get a verdict that may be wrong, as with any Bloom filter.
An empty list or universe gives a cascade without levels: nothing, or just the list, is listed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.shared import fresh, staged
from pulsemill.plans.skew import skew_join

SEGMENT = 1 << 15
SEGMENT_BYTES = SEGMENT // 8
FLAT_BYTES = 16 << 20
LEAST_BITS, MOST_HASHES = 8, 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bits(key: Column, level: int, hashes: int) -> list[Column]:
    """Places of a key in its segment: steps of odd width from a first place, both from one hash."""
    h = F.xxhash64(F.lit(level), key)
    first, step = h.bitwiseAND(F.lit(SEGMENT - 1)), F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(SEGMENT - 1))
    odd = step.bitwiseOR(F.lit(1))
    return [(first + odd * F.lit(n)).bitwiseAND(F.lit(SEGMENT - 1)) for n in range(hashes)]


def _holds(bits: Column, offset: Column, places: Sequence[Column]) -> Column:
    """Whether all places are set in the bitmap that begins `offset` bytes into `bits`; none is in a null."""

    def one(place: Column) -> Column:
        at = (offset + F.shiftright(place, 3) + F.lit(1)).cast("int")
        # A byte as a number: the code of its Latin-1 letter.
        byte = F.ascii(F.decode(F.substring(bits, at, F.lit(1)), "ISO-8859-1"))
        return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1

    return F.coalesce(reduce(lambda a, b: a & b, map(one, places)), F.lit(False))


@dataclass(frozen=True)
class Cascade:
    """Bitmaps (shard, level, bits) of all shards; `hashes` places for each key in each level."""

    bitmaps: DataFrame
    shards: int
    hashes: int
    levels: int

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), key), F.lit(self.shards)).cast("int")

    def flat(self, level: int) -> Column:
        """One constant with the bitmaps of a level in the order of shards."""
        empty = F.lit("00" * SEGMENT_BYTES)
        held = self.bitmaps.filter(F.col("level") == level).select("shard", F.hex("bits").alias("bits"))
        rows = self.bitmaps.sparkSession.range(self.shards).select(F.col("id").cast("int").alias("shard"))
        rows = rows.join(held, "shard", "left").select("shard", F.coalesce("bits", empty).alias("bits"))
        ordered = F.array_sort(F.collect_list(F.struct("shard", "bits")))
        return rows.agg(F.unhex(F.array_join(F.transform(ordered, lambda r: r["bits"]), "")).alias("bits")).scalar()


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
    """The cascade that tells the `key`s of `listed` from all others of `universe`."""
    both = universe.select(F.col(key).alias("key"), F.lit(False).alias("listed")).unionByName(
        listed.select(F.col(key).alias("key"), F.lit(True).alias("listed"))
    )
    keys = staged(both.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed")), "cascade-keys")
    count = keys.agg(F.count_if("listed").alias("n"), F.count_if(~F.col("listed")).alias("others")).first()
    ratio = max(count["others"], 1) / max(count["n"], 1)
    bits = max(LEAST_BITS, math.log2(max(ratio, 1)) / math.log(2))
    shards = max(1, math.ceil(count["n"] * bits / SEGMENT))
    hashes = min(MOST_HASHES, round(bits * math.log(2)))
    made = Cascade(keys, shards, hashes, 0)

    alive = keys.withColumn("shard", made.shard(F.col("key")))
    levels: list[DataFrame] = []
    left = count["n"]
    while left:
        level = len(levels) + 1
        own = F.col("listed") == F.lit(level % 2 == 1)
        places = alive.filter(own).select("shard", F.explode(F.array(*_bits(F.col("key"), level, hashes))).alias("place"))
        held = staged(places.groupBy("shard").agg(F.bitmap_construct_agg("place").alias("bits")), "cascade-level")
        levels.append(held.select("shard", F.lit(level).alias("level"), "bits"))
        # The bitmaps of few shards go to the keys, the keys of many shards are dealt evenly.
        lookup = F.broadcast(held) if shards * SEGMENT_BYTES <= FLAT_BYTES else held
        passed = alive.join(lookup, "shard").filter(own | _holds(F.col("bits"), F.lit(0), _bits(F.col("key"), level, hashes)))
        alive = staged(passed.drop("bits"), "cascade-alive")
        left = alive.filter(F.col("listed") != F.lit(level % 2 == 1)).count()
    bitmaps = reduce(DataFrame.unionByName, levels) if levels else keys.sparkSession.createDataFrame([], "shard int, level int, bits binary")
    return Cascade(bitmaps, shards, hashes, len(levels))


def judged(df: DataFrame, cascade: Cascade, key: Column, name: str) -> DataFrame:
    """Add `name`: whether `key` is listed."""
    shard, own, held = fresh("shard", "key", "held")
    rows = df.withColumn(own, key)
    levels = range(cascade.levels, 0, -1)
    if cascade.shards * cascade.levels * SEGMENT_BYTES <= FLAT_BYTES:
        offset = cascade.shard(F.col(own)).cast("long") * F.lit(SEGMENT_BYTES)
        bits = {level: cascade.flat(level) for level in levels}
    else:
        offset = F.lit(0)
        per_shard = cascade.bitmaps.groupBy(F.col("shard").alias(shard)).agg(
            F.map_from_entries(F.collect_list(F.struct("level", "bits"))).alias(held)
        )
        rows = skew_join(rows.withColumn(shard, F.coalesce(cascade.shard(F.col(own)), F.lit(-1))), per_shard, [shard], "left")
        bits = {level: F.try_element_at(F.col(held), F.lit(level)) for level in levels}
    found = F.lit(cascade.levels % 2 == 1)
    for level in levels:
        inside = _holds(bits[level], offset, _bits(F.col(own), level, cascade.hashes))
        found = F.when(inside, found).otherwise(F.lit(level % 2 == 0))
    return rows.withColumn(name, F.col(own).isNotNull() & found).select(*df.columns, name)


def address(url: Column) -> tuple[Column, Column]:
    """(host, path) of an address; both empty without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = [F.coalesce(F.regexp_extract(url, pattern, n), F.lit("")) for n in (1, 2)]
    return F.translate(parts[0], UPPER, LOWER), parts[1]


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the rules (verdict, host, path) that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def filter_addresses(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    cascade: Cascade,
    url: str = "url",
    names: Sequence[str] = ("host", "path", "rule", "verdict"),
) -> DataFrame:
    """Replace or add host, path, rule and verdict: the rule's, else block for listed keys (host and path)."""
    host, path, rule, says, listed = fresh("host", "path", "rule", "says", "listed")
    own = address(F.col(url))
    rows = pages.withColumns({host: own[0], path: own[1]})
    rows = rows.withColumns(dict(zip((rule, says), rule_of(F.col(host), F.col(path), rules))))
    rows = judged(rows, cascade, F.concat(host, path), listed)
    method = F.when(F.col(listed), F.lit("block")).otherwise(F.lit("allow"))
    kept = [c for c in pages.columns if c not in names]
    found = [F.col(host), F.col(path), F.col(rule), F.coalesce(F.col(says), method)]
    return rows.select(*kept, *[c.alias(n) for c, n in zip(found, names)])


def keys_of_blocked_hosts(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url"
) -> tuple[DataFrame, DataFrame]:
    """(listed, universe): all distinct keys, and those no rule fits on hosts of which the rules block more
    distinct keys than they allow."""
    host, path = address(F.col(url))
    keys = pages.select(host.alias("host"), path.alias("path")).distinct()
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    keys = staged(keys.select("host", F.concat("host", "path").alias("key"), says.alias("says")), "cascade-universe")
    balance = keys.groupBy("host").agg(F.count_if(F.col("says") == "block").alias("bad"), F.count_if(F.col("says") == "allow").alias("good"))
    bad = balance.filter("bad > good").select("host")
    listed = skew_join(keys.filter("says is null"), bad, ["host"], "left_semi")
    return listed.select("key"), keys.select("key")
