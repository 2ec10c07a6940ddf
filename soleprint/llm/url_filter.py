"""URL filters: host and path rules, and a Bloom filter cascade for lists of keys.

A cascade answers "is this key listed?" exactly for every key of a known universe. Its first level
is a Bloom filter of the listed keys; the second one of the other keys that the first lets
through; the third one of the listed keys that the second lets through; and so on until nothing
wrong is left. Each level is an array of longs in the plan, so looking keys up needs no join.

The arrays go to every task. Keys are therefore split by hash into shards, as many as it takes to
keep each cascade under ``shard_bytes``; each pass over the pages handles one shard.
"""

import json
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soleprint.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A rule for a host, all its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty for null and without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; of equals, the first to block."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` bits per key of the ``64 * len(words)`` in ``words``."""

    seed: int
    hashes: int
    words: list[int]

    def holds(self, key: Column) -> Column:
        # One text, which the optimizer turns into an array once: a literal for each word takes long.
        array = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        tests = []
        for bit in bit_positions(key, self.seed, self.hashes, 64 * len(self.words)):
            word = F.element_at(array, F.shiftright(bit, 6).cast("int") + 1)
            tests.append(F.getbit(word, F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return reduce(lambda a, b: a & b, tests)


def bit_positions(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def filter_size(keys: int, rate: float) -> tuple[int, int]:
    """Words and hashes of a Bloom filter for so many keys at a false-positive rate."""
    bits = max(64, math.ceil(keys * math.log2(1 / rate) / math.log(2)))
    return math.ceil(bits / 64), max(1, round(math.log2(1 / rate)))


def _level(keys: DataFrame, count: int, seed: int, rate: float) -> Level:
    words, hashes = filter_size(count, rate)
    bit = F.explode(F.array(*bit_positions(F.col("key"), seed, hashes, 64 * words)))
    parts = keys.select(bit.alias("bit")).groupBy(
        F.shiftright("bit", 6).cast("int").alias("word")).agg(F.expr(
            "bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("set"))
    filled = [0] * words
    for row in parts.collect():  # at most ``shard_bytes`` / 8 rows
        filled[row["word"]] = row["set"]
    return Level(seed, hashes, filled)


@dataclass(frozen=True)
class Cascade:
    """Levels in order; a key is listed if the first level that lacks it is an even one."""

    levels: list[Level]

    def lists(self, key: Column) -> Column:
        """True for listed keys of the universe."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[depth].holds(key), F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(keys: DataFrame, rate: float = 0.25, max_levels: int = 64) -> Cascade:
    """The cascade for ``keys``: distinct ``key`` and ``listed``, the complete universe.

    The first level's rate follows the share of listed keys, so that about as many others get
    through as there are listed keys; the further ones have ``rate``.
    """
    counts = dict(keys.groupBy("listed").count().collect())
    ours, theirs = keys.where("listed"), keys.where("NOT listed")
    held, others = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    first = min(0.5, max(1e-6, held / max(1, others) * math.sqrt(0.5)))
    while held:
        if len(levels) == max_levels:
            raise ValueError(f"{held} keys are still undecided after {max_levels} levels")
        level = _level(ours, held, len(levels), rate if levels else first)
        levels.append(level)
        ours, theirs = theirs.where(level.holds(F.col("key"))), ours
        held = ours.count()
    return Cascade(levels)


def shard_count(listed: int, shard_bytes: int, bits_per_key: int = 16) -> int:
    """Shards that keep a cascade of so many listed keys under ``shard_bytes``."""
    return max(1, math.ceil(listed * bits_per_key / 8 / shard_bytes))


def mark_listed(
    rows: DataFrame, key: str, universe: DataFrame, shard_bytes: int = 8 << 20,
) -> DataFrame:
    """``rows`` with a boolean ``listed``, exact for each key of ``universe``.

    ``universe`` holds distinct text keys ``key`` with a boolean ``listed``, and covers all keys in
    ``rows``; a null key is not listed. No join: each shard's cascade is part of its pass.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    listed = universe.where("listed").count()
    shards = shard_count(listed, shard_bytes)
    def shard(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column), F.lit("shard")), F.lit(shards))
    kept = universe.select("key", "listed").checkpoint()
    passes = []
    for number in range(shards):
        cascade = build_cascade(kept.where(shard("key") == number) if shards > 1 else kept)
        part = rows.where(shard(key) == number) if shards > 1 else rows
        passes.append(part.withColumn(
            "listed", F.col(key).isNotNull() & cascade.lists(F.col(key))))
    return reduce(DataFrame.unionByName, passes)


def judge_urls(
    pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each row of ``pages``.

    ``listed`` holds the keys to block, host and path put together, in a column ``key``. A rule
    decides where one fits, else the list: blocked if listed, else allowed. Keys of the list that
    no page has do no harm. A null URL and one without ``://`` have an empty host and path, and
    the empty key. URLs are read whole, however long. Repeated rows are judged alike and all stay; an
    empty table gives none.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"),
                        path.alias("path")).withColumn("key", F.concat("host", "path"))
    marks = rows.select("key", F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(True).alias("listed")).where("key IS NOT NULL"))
    universe = marks.groupBy("key").agg(F.max("listed").alias("listed"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return mark_listed(rows, "key", universe, shard_bytes).select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def sample_list(pages: DataFrame, url: str = "url") -> DataFrame:
    """A stand-in for a published list: the keys of ``pages`` whose MD5 begins with 0, 1, 2 or 3.

    It so grows with the pages, and SQL can say which keys are on it.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    keys = pages.select(F.concat(host, path).alias("key")).distinct()
    return keys.where(F.substring(F.md5(F.col("key").cast("binary")), 1, 1).isin(*"0123"))
