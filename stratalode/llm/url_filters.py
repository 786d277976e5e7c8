"""URL filters: prefix rules first, then exact list membership by a cascade of Bloom filters.

Level 0 of a cascade encodes the listed keys, level 1 the keys of the universe
that level 0 takes for listed by mistake, level 2 the listed keys that level 1
takes by mistake, and so on until no mistake is left. Over the universe it was
built for the answer is therefore exact. Only column expressions are used: a
level is an array of 64-bit words that Spark folds into a constant of the plan,
and nothing is joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalode.sinks import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty if there is no host part."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def longest_rule(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """The longest fitting rule as struct<rule, verdict>, NULL where none fits."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """A Bloom filter: its size in bits, its hashes, its seed, and its words as text."""

    bits: int
    hashes: int
    seed: int
    words: str

    def positions(self, key: Column) -> list[Column]:
        return _positions(key, self.bits, self.hashes, self.seed)

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        hit = F.lit(True)
        for at in self.positions(key):
            word = F.get(words, F.floor(at / 64).cast("int"))
            hit = hit & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return hit


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def level_size(count: int, others: int) -> tuple[int, int]:
    """Bits and hashes of a level of ``count`` keys that is asked for ``others`` as well.

    It takes fewer of them by mistake than it has keys, about seven tenths, so that
    the next level is smaller than this one however many the others are.
    """
    wrong = min(0.5, 0.7 * max(count, 1) / max(others, 1))
    hashes = max(1, math.ceil(-math.log2(wrong)))
    return max(64, math.ceil(count * hashes / math.log(2))), hashes


def _encode(keys: DataFrame, bits: int, hashes: int, seed: int) -> Level:
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed))).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("at", F.lit(64)).cast("int"))).alias("bits")
    )
    filled = ["0"] * (bits // 64 + 1)
    for row in words.collect():  # one row per 64 bits of a filter whose size the caller bounds
        filled[row["word"]] = str(row["bits"])
    return Level(bits, hashes, seed, ",".join(filled))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed. NULL is not."""
        depth = len(self.levels)
        answer = F.lit(depth % 2 == 1)
        for i in reversed(range(depth)):
            answer = F.when(~self.levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(answer)
        return F.coalesce(key.isNotNull() & answer, F.lit(False))


def build_cascade(keys: DataFrame, bits_per_key: int | None = None, hashes: int = 4, seed: int = 1) -> Cascade:
    """The cascade for distinct ``keys`` (key, listed), which are the whole universe.

    Levels are sized by :func:`level_size`, or with ``bits_per_key`` and ``hashes`` where given.
    """
    inside, outside = keys.where("listed"), keys.where("not listed")
    levels: list[Level] = []
    count, others = inside.count(), outside.count()
    while count:
        bits, used = level_size(count, others) if bits_per_key is None else (max(64, count * bits_per_key), hashes)
        levels.append(_encode(inside, bits, used, seed + len(levels)))
        inside, outside = outside.where(levels[-1].holds(F.col("key"))), inside
        count, others = inside.count(), count
    return Cascade(tuple(levels))


def with_membership(
    rows: DataFrame,
    key: Column,
    listed: Column | DataFrame,
    name: str = "listed",
    bits_per_key: int | None = None,
    hashes: int = 4,
    max_bits: int = 1 << 23,
) -> DataFrame:
    """Rows with a boolean column ``name``: whether ``key`` is listed.

    ``listed`` is a table of keys (key, listed), or a condition on the column ``key``
    that tells which keys of the universe stand on the list. The universe are the
    distinct keys of ``rows``. The filters are constants of the plan; where the first
    level, the largest, would exceed ``max_bits``, keys are split by hash into as many
    shards as needed, each with a cascade of its own, and the rows of one shard after
    another are judged by theirs. NULL keys are never listed; an empty table gives an
    empty result. A column called ``name`` is replaced.
    """
    keys = rows.select(key.alias("key")).where("key is not null").distinct()
    if isinstance(listed, DataFrame):
        marked = listed.where("key is not null").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))
        keys = keys.withColumn("listed", F.lit(False)).unionByName(marked).groupBy("key").agg(F.bool_or("listed").alias("listed"))
    else:
        keys = keys.withColumn("listed", F.coalesce(listed, F.lit(False)))
    keys = stage(keys, "url-keys")
    count, others = keys.select(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    largest = level_size(count, others)[0] if bits_per_key is None else count * bits_per_key
    shards = max(1, -(-largest // max_bits))
    if shards == 1:
        cascade = build_cascade(keys, bits_per_key, hashes)
        return rows.withColumn(name, cascade.contains(key))
    parts = None
    for shard in range(shards):
        cascade = build_cascade(keys.where(_shard(F.col("key"), shards) == shard), bits_per_key, hashes)
        own = rows.where(_shard(key, shards) == shard).withColumn(name, cascade.contains(key))
        parts = own if parts is None else parts.unionByName(own)
    return parts


def hosts_of_links(pages: DataFrame, percent: int = 110, url: str = "url", html: str = "html") -> DataFrame:
    """The hosts of ``pages`` (key) and whether their pages hold unusually many links (listed).

    A host is listed if its links per character of html exceed ``percent`` of those
    of all pages together. This takes all pages of a host and of the table, so no
    expression on a row tells it. Numbers are compared as whole ones. NULL and empty
    html have no links and no characters; the empty host is never listed; an empty
    table gives an empty result.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    links = (F.length(page) - F.length(F.replace(page, F.lit("<a "), F.lit("")))) / 3
    each = pages.select(url_host(F.col(url)).alias("key"), links.cast("bigint").alias("links"), F.length(page).alias("chars"))
    hosts = stage(each.groupBy("key").agg(F.sum("links").alias("links"), F.sum("chars").alias("chars")), "hosts")
    links, chars = (F.lit(n or 0).cast("decimal(18,0)") for n in hosts.agg(F.sum("links"), F.sum("chars")).first())

    def times(number: str, total: Column, by: int) -> Column:
        return F.col(number).cast("decimal(15,0)") * total * F.lit(by).cast("decimal(4,0)")

    return hosts.select("key", ((F.col("key") != "") & (times("links", chars, 100) > times("chars", links, percent))).alias("listed"))


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), F.coalesce(key, F.lit(""))), F.lit(shards))


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    listed: Column | DataFrame,
    url: str = "url",
    max_bits: int = 1 << 23,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``host_listed``.

    The longest fitting rule gives the verdict; where none fits, listed hosts are
    blocked and all others allowed. ``listed`` is a table of hosts (key, listed), such
    as :func:`hosts_of_links` gives, or a condition on a column ``key``, the host. NULL urls and urls without ``://`` have an empty host and path.
    Columns of the same names are replaced, all others kept; repeated rows stay.
    """
    rows = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    rows = with_membership(rows, F.col("host"), listed, "host_listed", max_bits=max_bits)
    found = longest_rule(F.col("host"), F.col("path"), rules)
    default = F.when(F.col("host_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumns({"rule": found["rule"], "verdict": F.coalesce(found["verdict"], default)})
