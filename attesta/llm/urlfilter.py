"""URL filter: host and path rules, then an exact Bloom filter cascade.

A cascade answers membership in a key list without a join. Level 0 encodes the
listed keys; level 1 encodes the keys of the corpus that pass level 0 without
being listed; level 2 the listed keys that pass level 1, and so on until a level
has no false positive. Since the levels are built over every key of the corpus,
the answer is exact for all of them. A filter is a row of 64-bit words that
reaches the probing expression as a scalar subquery, so judging urls takes one
pass over the url column, no shuffle and no Python.

Filters are bounded: a list whose first level would exceed `max_bits` is cut by
key hash into shards with a cascade each. The rows of a shard are judged with
its own filters only, so memory stays bounded and every key is still judged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Action for a host, its subdomains, and the paths that start with `path`."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class CascadeParams:
    later_rate: float = 0.125  # false positive rate of every level after the first
    max_bits: int = 1 << 26  # bound of a shard's first filter: 8 MiB
    max_levels: int = 60


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    number: int
    words: DataFrame  # one row, column words: array<bigint>

    def contains(self, key: Column) -> Column:
        words, found = self.words.scalar(), F.lit(True)
        for position in positions(key, self.number, self.hashes, self.bits):
            word = F.get(words, F.shiftright(position, 6).cast("int"))
            bit = F.lit(1).cast("bigint")
            one = F.call_function("shiftleft", bit, (position.bitwiseAND(F.lit(63))).cast("int"))
            found = found & (word.bitwiseAND(one) != 0)
        return found


def host_of(url: Column) -> Column:
    """Text between the first `://` and `/`, `?`, `#` or the end; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Text from the host's end to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits; null if none does."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        action = F.when(fits, F.lit(rule.action)).otherwise(action)
    return name, action


def positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("bigint"))
        for i in range(hashes)
    ]


def build_level(keys: DataFrame, number: int, rate: float, n_keys: int) -> Level:
    """Filter over the `key` column: words are OR-ed on the map side first."""
    hashes = max(1, math.ceil(-math.log2(rate)))
    n_words = max(1, math.ceil(n_keys * hashes / math.log(2) / 64))
    bits = n_words * 64
    spark = keys.sparkSession
    position = F.explode(F.array(*positions(F.col("key"), number, hashes, bits)))
    shift = (F.col("p").bitwiseAND(F.lit(63))).cast("int")
    one = F.lit(1).cast("bigint")
    set_bits = keys.select(position.alias("p")).select(
        F.shiftright("p", 6).alias("word"), F.call_function("shiftleft", one, shift).alias("bit")
    )
    empty = spark.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bit"))
    words = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("word", "bit"))).alias("all"))
    return Level(bits, hashes, number, staged(row.select(F.col("all.bit").alias("words")), "filter"))


def build_cascade(listed: DataFrame, universe: DataFrame, params: CascadeParams) -> list[Level]:
    """Levels for one shard. Both frames have a column `key`; repeats are allowed.

    An empty list gives no level: nothing is a member.
    """
    inside = staged(listed.filter(F.col("key").isNotNull()).distinct(), "listed")
    n_inside = inside.count()
    if not n_inside:
        return []
    n_all = universe.select(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, n_inside * math.sqrt(0.5) / max(1, n_all - n_inside))
    levels: list[Level] = []
    include, exclude, n_include = inside, None, n_inside
    while n_include:
        if len(levels) == params.max_levels:
            raise RuntimeError("the cascade did not end; choose another later_rate")
        level = build_level(include, len(levels), rate, n_include)
        levels.append(level)
        if exclude is None:  # the one pass over the corpus
            passed = universe.filter(level.contains(F.col("key"))).distinct()
            wrong = passed.join(inside, "key", "left_anti")
        else:
            wrong = exclude.filter(level.contains(F.col("key")))
        wrong = staged(wrong, "passed")
        include, exclude, n_include = wrong, include, wrong.count()
        rate = params.later_rate
    return levels


def member(key: Column, levels: list[Level]) -> Column:
    """Exact membership of a corpus key: it is listed when the first level that
    rejects it has an odd number, or the last level reached has an even one."""
    if not levels:
        return F.lit(False)
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(level.contains(key), answer).otherwise(F.lit(level.number % 2 == 1))
    return answer


def with_membership(
    rows: DataFrame, listed: DataFrame, params: CascadeParams | None = None
) -> DataFrame:
    """`rows` (with a column `key`) plus a column `listed`; null keys are not listed.

    Only the listed keys that occur in `rows` count. Built shard by shard when the
    list is too long for one filter.
    """
    params = params or CascadeParams()
    listed = listed.select("key")
    n_listed = listed.select(F.approx_count_distinct("key")).first()[0]
    shards = max(1, math.ceil(n_listed * 32 / params.max_bits))
    shard = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(shards))
    parts = []
    for i in range(shards):
        own = rows if shards == 1 else rows.filter(shard == i)
        own_list = listed if shards == 1 else listed.filter(shard == i)
        keys = own.select("key").filter(F.col("key").isNotNull())
        levels = build_cascade(own_list, keys, params)
        is_member = member(F.col("key"), levels) & F.col("key").isNotNull()
        parts.append(own.withColumn("listed", is_member))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule],
    params: CascadeParams | None = None,
    id_column: str = "page_id",
) -> DataFrame:
    """Verdict per page from its url: the longest rule's, else block if listed.

    A null url or one without `://` has an empty host and path. Repeated pages
    keep a row each; columns other than the id and `url` are not read. `listed`
    has the key host + path in a column `key`. An empty table gives no rows.
    """
    rows = pages.select(
        F.col(id_column).alias("page_id"), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).withColumn("key", F.concat("host", "path"))
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return with_membership(rows, listed, params).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(action, by_list).alias("verdict"), "listed",
    )


def low_quality_keys(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Url keys whose last number is a document labelled as low quality."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html|/)?$", 1)
    bad = labels.filter(F.col("quality") == 0).select(F.col("doc_id").cast("bigint").alias("n"))
    keys = pages.select(
        F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("key"),
        F.when(number != "", number).cast("bigint").alias("n"),
    )
    return keys.join(bad, "n", "left_semi").select("key").distinct()
