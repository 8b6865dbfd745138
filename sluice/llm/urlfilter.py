"""URL filter by a Bloom filter cascade (DataFrame expressions only).

The cascade gives exact membership for every key of a closed universe, here all
hosts of the corpus and their parent domains. Level 0 encodes the listed keys;
level 1 those unlisted keys of the universe that level 0 takes for listed;
level 2 the listed keys that level 1 takes for unlisted; and so on until a level
has no false positive. A key's answer is the parity of the first level that
does not hold it. The filter's size follows the list, not the corpus, so it
travels as a constant and no page is joined or shuffled. A list beyond
MAX_LISTED keys is split by hash into several cascades of bounded size.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and is not listed; empty tables and an empty list allow every
page; repeated pages are judged alike; null list keys are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, only, staged

#: Listed keys of one cascade; its filters then stay under some 16 MB.
MAX_LISTED = 4_000_000
FALSE_POSITIVES = 1 / 16


def split_url(url: Column) -> Column:
    """struct(host, path) of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))

    def parts(r: Column) -> Column:
        host = F.coalesce(F.regexp_extract(r, r"^[^/?#]*", 0), F.lit(""))
        after = F.coalesce(F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
        return F.struct(ascii_lower(host).alias("host"), after.alias("path"))

    return let(rest, parts)


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def rule_for(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*[
        F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered
    ], F.lit(None).cast("struct<rule:string,verdict:string>"))


def domains(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.when(F.coalesce(host, F.lit("")) == "", F.array().cast("array<string>")).otherwise(let(
        labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), "."))
    ))


class Level:
    """A Bloom filter as one binary constant."""

    def __init__(self, number: int, bits: int, hashes: int, data: bytes = b""):
        self.number, self.bits, self.hashes, self.data = number, bits, hashes, data

    def positions(self, key: Column) -> list[Column]:
        hashes = [F.xxhash64(key, F.lit(self.number), F.lit(i)) for i in range(self.hashes)]
        return [F.pmod(h, F.lit(self.bits).cast("long")) for h in hashes]

    def holds(self, key: Column) -> Column:
        data = F.lit(self.data)
        tests = []
        for at in self.positions(key):
            byte = F.conv(F.hex(F.substring(data, (F.floor(at / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
            tests.append(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1)
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def _level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    bits = 8 * max(1, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2 / 8))
    level = Level(number, bits, max(1, round(math.log2(1 / rate))))
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    byte = F.floor(F.col("at") / 8).cast("int")
    rows = at.groupBy(byte.alias("byte")).agg(F.bit_or(F.pow(F.lit(2), F.col("at") % 8).cast("int")).alias("v")).collect()
    data = bytearray(bits // 8)  # at most bits / 8 rows: bounded by MAX_LISTED, not by the corpus
    for r in rows:
        data[r["byte"]] = r["v"]
    level.data = bytes(data)
    return level


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Exact for every key of the universe: the first level that lacks the key decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.holds(key), out).otherwise(F.lit(level.number % 2 == 1))
        return out


@dataclass(frozen=True)
class Membership:
    """Cascades by the hash of a key; together they answer for the whole universe."""

    parts: tuple[Cascade, ...]

    def listed(self, key: Column) -> Column:
        if len(self.parts) == 1:
            return self.parts[0].listed(key)
        part = F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(len(self.parts)))
        out = F.lit(False)
        for i, cascade in enumerate(self.parts):
            out = F.when(part == i, cascade.listed(key)).otherwise(out)
        return out


def build(universe: DataFrame, listed: DataFrame, rate: float = FALSE_POSITIVES, max_listed: int = MAX_LISTED) -> Membership:
    """Cascade(s) for the distinct keys of ``universe`` (column ``key``), of which
    those in ``listed`` (column ``key``) are members."""
    listed = listed.where(F.col("key").isNotNull()).select("key").distinct()
    universe = universe.where(F.col("key").isNotNull()).select("key").distinct()
    marked = staged(
        universe.select("key", F.lit(False).alias("member")).unionByName(listed.select("key", F.lit(True).alias("member")))
        .groupBy("key").agg(F.max("member").alias("member")),
        "cascade-universe",
    )
    total = marked.where("member").count()
    n_parts = max(1, math.ceil(total / max_listed))
    parts = []
    for p in range(n_parts):
        mine = marked if n_parts == 1 else marked.where(F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(n_parts)) == p)
        encode, other, levels = mine.where("member"), mine.where("NOT member"), []
        while n := encode.count():
            # the first level is sharper where unlisted keys outnumber the listed ones
            p0 = rate if levels else min(rate, max(1e-6, n / max(1, other.count())))
            level = _level(encode, len(levels), n, p0)
            levels.append(level)
            wrong = other.where(level.holds(F.col("key")))
            encode, other = wrong, encode
        parts.append(Cascade(tuple(levels)))
    return Membership(tuple(parts))


def judge(pages: DataFrame, rules: Sequence[Rule], membership: Membership, *, page_id="page_id", url="url") -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, listed)."""
    parts = only(pages, page_id=page_id, url=url).select("page_id", split_url(F.col("url")).alias("u")).select("page_id", "u.host", "u.path")
    listed = F.exists(domains(F.col("host")), membership.listed)
    hit = rule_for(rules, F.col("host"), F.col("path"))
    return parts.select("page_id", "host", "path", hit.alias("hit"), listed.alias("listed")).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "listed",
    )


def keys_of(pages: DataFrame, url: str = "url") -> DataFrame:
    """The complete key universe: every host of the pages and its parent domains."""
    hosts = only(pages, url=url).select(split_url(F.col("url"))["host"].alias("host")).distinct()
    return hosts.select(F.explode(domains(F.col("host"))).alias("key")).distinct()


#: The rules of the registered query.
RULES = (
    Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"), Rule("com/de/", "block"),
)


def query(pages: DataFrame) -> DataFrame:
    """The list holds the domains of three labels or more whose MD5 starts with 0 or 1."""
    universe = keys_of(pages)
    listed = universe.where((F.size(F.split("key", r"\.")) >= 3) & F.md5(F.col("key").cast("binary")).substr(1, 1).isin("0", "1"))
    return judge(pages, RULES, build(universe, listed))


ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), hosts AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM split),
keys AS (
  SELECT host, array_to_string(labels[i:], '.') AS key, len(labels) - i + 1 AS n
  FROM (SELECT host, labels, unnest(range(1, len(labels) + 1)) AS i FROM hosts WHERE host <> '')
), blocked AS (SELECT DISTINCT host FROM keys WHERE n >= 3 AND substr(md5(key), 1, 1) IN ('0', '1')),
ruled AS (
  SELECT s.*, b.host IS NOT NULL AS listed,
    CASE WHEN (s.host = 'example.org' OR s.host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (s.host = 'example.org' OR s.host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (s.host = 'com' OR s.host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (s.host = 'com' OR s.host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (s.host = 'org' OR s.host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split s LEFT JOIN blocked b ON s.host = b.host
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
