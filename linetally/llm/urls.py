"""URL filter rules decided by a cascade of Bloom filters (native).

A rule is a host with a path prefix (``example.net/en/``). Whether a key is
listed is answered from a few bit strings instead of a join:

* level 1 holds the listed keys; some unlisted keys of the corpus pass it,
* level 2 holds exactly those false positives; some listed keys pass it,
* level 3 holds those listed keys, and so on until a level lets no wrong
  key through.

Because the levels are built against *every* key that the corpus can ask
for (:func:`url_keys` over all rows, distinct), the answer for these keys
is exact. The first level is sized so that its false positives are about as
many as the listed keys, so all levels together take a few bytes for each
listed key times the logarithm of (corpus keys / listed keys); they do not
grow with the number of pages. The bit strings are literals of the
expression: no join, no shuffle, no Python on the rows.

Results for odd input: a null url, or one without ``://``, has empty host and
path and no rule; an empty table gives an empty result; repeated rows are
judged alike, each kept; a rule list without rules blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import carried, lower_ascii

#: False positive rate of every level after the first.
NEXT_RATE = 0.5
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    action: str  # "block" or "allow"
    host: str
    path: str  # prefix of the url's path, starts with "/"

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        """Number of host labels, length of the path prefix."""
        return self.host.count(".") + 1, len(self.path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or
    has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def url_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The keys under which rules of these shapes can list a url, longest
    first: for each shape the last labels of the host with the start of the
    path (null where host or path is too short)."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    keys = []
    for n, length in shapes:
        long_enough = (labels >= n) & (F.length(path) >= length) & (F.length(host) > 0)
        keys.append(F.when(long_enough, F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, length))))
    if not keys:
        return F.array().cast("array<string>")
    by_length = lambda a, b: (
        F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1)
        .when(F.instr(a, "/") > F.instr(b, "/"), -1).when(F.instr(a, "/") < F.instr(b, "/"), 1).otherwise(0))
    return F.array_sort(F.filter(F.array(*keys), lambda k: k.isNotNull()), by_length)


@dataclass(frozen=True)
class Level:
    bits: bytes
    n_bits: int
    n_hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed + i)), F.lit(self.n_bits)) for i in range(self.n_hashes)]

    def holds(self, key: Column) -> Column:
        out = F.lit(True)
        for p in self.positions(key):
            at = F.floor(p / F.lit(8)).cast("int") + F.lit(1)
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), at, F.lit(1))), 16, 10).cast("int")
            out = out & (F.getbit(byte, (p % F.lit(8)).cast("int")) == F.lit(1))
        return out


def _level(keys: DataFrame, n_keys: int, rate: float, number: int) -> Level:
    """Bloom filter of the column ``key``. The bits are combined by
    ``bit_or`` in the executors; the driver gets one row for each 32 bits,
    and the number of bits follows from ``n_keys`` and ``rate`` alone."""
    n_bits = max(64, 8 * math.ceil(n_keys * -math.log(rate) / math.log(2) ** 2 / 8))
    empty = Level(b"", n_bits, max(1, round(-math.log2(rate))), 1000 * number)
    bit = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("p"))
    cells = (
        bit.groupBy(F.floor(F.col("p") / 32).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 32 AS INT))")).alias("bits"))
        .collect()
    )
    data = bytearray(4 * math.ceil(n_bits / 32))
    for row in cells:
        at = 4 * int(row["cell"])
        data[at: at + 4] = int(row["bits"]).to_bytes(4, "little")
    return Level(bytes(data), n_bits, empty.n_hashes, empty.seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Exact for every key the cascade was built against. The first level
        that does not hold the key tells: an odd level (the listed side) says
        no, an even one yes; a key held by all belongs to the last one's side."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade for the ``key`` column of ``listed`` against all of ``universe``
    (distinct keys; neither is collected). Actions: two or three for each level."""
    inside = listed.select("key").where(F.col("key").isNotNull()).distinct()
    n_inside = inside.count()
    if n_inside == 0:
        return Cascade(())
    outside = universe.select("key").where(F.col("key").isNotNull()).join(inside, "key", "left_anti")
    n_outside = outside.count()
    levels: list[Level] = []
    rate = min(NEXT_RATE, n_inside * math.sqrt(0.5) / max(1, n_outside))
    while len(levels) < MAX_LEVELS:
        level = _level(inside, n_inside, rate, len(levels) + 1)
        levels.append(level)
        wrong = outside.where(level.holds(F.col("key")))
        n_wrong = wrong.count()
        if n_wrong == 0:
            return Cascade(tuple(levels))
        inside, outside, n_inside, rate = wrong, inside, n_wrong, NEXT_RATE
    raise RuntimeError("the cascade does not end; the hash function is degenerate")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with the columns ``host``, ``path``, ``rule`` (key of the
    longest rule that fits, else null) and ``verdict`` (its action, else
    ``default``: an unlisted url). Input columns of these names are replaced.

    Two cascades, of the blocked and of the allowed keys, are built against
    all keys of all pages; each page then tests its own few keys."""
    spark = pages.sparkSession
    shapes = sorted({r.shape for r in rules})
    host, path = url_parts(F.col(url))
    keep = carried(pages, ("host", "path", "rule", "verdict"))
    parts = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = url_keys(F.col("host"), F.col("path"), shapes)
    universe = materialize(parts.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    cascades = {}
    for action in ("block", "allow"):
        own = [(r.key,) for r in rules if r.action == action]
        cascades[action] = build_cascade(spark.createDataFrame(own, "key string"), universe)

    def action_of(key: Column) -> Column:
        return F.when(cascades["block"].listed(key), "block").when(cascades["allow"].listed(key), "allow")

    found = F.filter(
        F.transform(keys, lambda k: F.struct(k.alias("rule"), action_of(k).alias("action"))),
        lambda x: x["action"].isNotNull(),
    )
    judged = parts.withColumn("_hit", F.get(found, F.lit(0)))
    return judged.withColumns({
        "rule": F.col("_hit.rule"),
        "verdict": F.coalesce(F.col("_hit.action"), F.lit(default)),
    }).drop("_hit")
