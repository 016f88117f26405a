"""URL filter: host and path rules, and a block list held as a Bloom filter cascade.

A block list names domains; an entry covers its subdomains. The key of a url is
its host, and the key universe is every host of the corpus. The cascade's first
level is a Bloom filter of the universe's listed hosts. The unlisted hosts that
it holds by mistake are the second level's keys, the listed ones which that
level holds by mistake are the third's, and so on until a level makes no
mistake. A host that misses a level is decided by it: unlisted at an odd level,
listed at an even one; one that all levels hold is of the last level's kind.
So for every host of the universe the answer is exact, and judging a row is
bit tests on one array of words: no join and no shuffle of the pages.

Level one takes as many bits a key as bring its mistakes down to the number of
listed keys; every later level takes one hash and half of what it should not
hold passes, so the levels shrink geometrically. The words travel as a scalar
subquery of at most ``MAX_BITS`` bits. Beyond that size the hosts are dealt to
shards, each with a cascade of its own, and judged in several passes over the
rows, one shard's words at a time.

All of it is DataFrame expressions. Building aggregates hosts first, so a host
that a third of all pages share counts once.

Defined results: a null url, or one without ``://``, has an empty host and path;
an empty host is never listed. Only A-Z are lower-cased. Entries that are null,
empty or longer than 253 characters (no domain name is) list nothing. Repeated
rows and ids are judged one by one, an empty table gives no rows, and other
columns of the input are dropped, so none can clash. Very long urls are read whole.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import written

MAX_BITS = 1 << 29
NAME_CHARS = 253
MAX_LEVELS = 200

# Fixed values of the contract: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Words between the hyphens of a label that put a domain on the query's block list
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
LISTED = rf"(?:^|\.)((?:[^.-]+-)*(?:{'|'.join(LISTED_WORDS)})(?:-[^.-]+)*\..+)$"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = None
    for name, start, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        hit = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def covered(hosts: DataFrame, entries: DataFrame) -> DataFrame:
    """(host, listed) of distinct ``hosts``: whether one of the domains in
    ``entries``, columns host and domain, is the host or stands above it."""
    # the labels of the longest suffix that a domain name has room for
    labels = F.split(F.when(F.length("host") <= NAME_CHARS, F.col("host")).otherwise(F.regexp_replace(
        F.right("host", F.lit(NAME_CHARS + 1)), r"^[^.]*\.?", "")), r"\.")
    above = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"))
    names = entries.select("domain").filter((F.col("domain") != "") & (F.length("domain") <= NAME_CHARS)).distinct()
    hit = above.join(names, "domain").select("host", F.lit(True).alias("listed"))
    return hosts.select("host", F.lit(False).alias("listed")).union(hit).groupBy("host").agg(F.max("listed").alias("listed"))


@dataclass(frozen=True)
class Level:
    number: int   # from 1; odd ones encode listed keys
    bits: int
    hashes: int
    start: int    # its first word among those of all levels

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column, words: Column) -> Column:
        out = F.lit(True)
        for p in self.places(key):
            word = words[(F.shiftright(p, 6) + self.start).cast("int")]
            bit = F.call_function("shiftright", word, p.bitwiseAND(F.lit(63)).cast("int"))
            out = out & (bit.bitwiseAND(F.lit(1)) == 1)
        return out


def level_words(keys: DataFrame, level: Level) -> DataFrame:
    """(at, word) of a level's filter, all of its words."""
    p = F.col("p")
    return (keys.select(F.explode(F.array(*level.places(F.col("host")))).alias("p"))
            .select((F.shiftright(p, 6) + level.start).alias("at"),
                    F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int")).alias("word"))
            .union(keys.sparkSession.range(level.start, level.start + level.bits // 64).select("id", F.lit(0).cast("long")))
            .groupBy("at").agg(F.bit_or("word").alias("word")))


def packed_words(words: DataFrame) -> Column:
    """All words in order, one array, as a scalar subquery."""
    return words.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words")).scalar()


def level_size(keys: int, others: int, number: int) -> tuple[int, int]:
    """(bits, hashes) of a level that encodes ``keys`` against ``others``."""
    rate = min(0.5, max(1, keys) / (math.sqrt(2) * others)) if number == 1 and others else 0.5
    bits = math.ceil(keys * math.log2(1 / rate) / math.log(2))
    return max(64, -(-bits // 64) * 64), max(1, round(math.log2(1 / rate)))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]
    words: DataFrame | None

    def decides(self, key: Column, words: Column) -> Column:
        """Whether a key of the universe is listed."""
        if not self.levels:
            return F.lit(False)
        out = None
        for level in self.levels:
            missed = ~level.holds(key, words)
            out = F.when(missed, level.number % 2 == 0) if out is None else out.when(missed, level.number % 2 == 0)
        return out.otherwise(self.levels[-1].number % 2 == 1)


def build(universe: DataFrame) -> Cascade:
    """The cascade of a universe (host, listed), of distinct hosts."""
    keys, others = universe.filter("listed").select("host"), universe.filter("NOT listed").select("host")
    n, m = keys.count(), others.count()
    levels, words, start = [], None, 0
    while n:
        number = len(levels) + 1
        if number > MAX_LEVELS:
            raise RuntimeError(f"{n} hosts are left after {MAX_LEVELS} levels")
        level = Level(number, *level_size(n, m, number), start)
        own = written(level_words(keys, level), "bloom-level")
        levels.append(level)
        words, start = own if words is None else words.union(own), start + level.bits // 64
        if not m:
            break
        # what the level should not hold but does, is what the next one encodes
        shift = Level(number, level.bits, level.hashes, 0)
        test = own.select((F.col("at") - level.start).alias("at"), "word")
        missed = written(others.select("host", packed_words(test).alias("words"))
                         .filter(shift.holds(F.col("host"), F.col("words"))).select("host"), "bloom-missed")
        keys, others = missed, keys
        n, m = keys.count(), n
    return Cascade(tuple(levels), words)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards))


def judge(pages: DataFrame, entries: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``entries`` has a
    column domain; building the filters runs their jobs."""
    host, path = parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    hosts = rows.select("host").filter("host <> ''").distinct()
    universe = written(covered(hosts, entries), "url-universe")
    n, m = universe.filter("listed").count(), universe.filter("NOT listed").count()
    # level one and, twice its listed keys' share, all that follow
    shards = max(1, math.ceil((level_size(n, m, 1)[0] + 6 * n) / max_bits))
    judged = rows.withColumn("listed", F.lit(False))
    for s in range(shards):
        own = build(universe if shards == 1 else universe.filter(shard_of(F.col("host"), shards) == s))
        if not own.levels:
            continue
        mine = (F.col("host") != "") & (shard_of(F.col("host"), shards) == s)
        judged = judged.withColumn("words", packed_words(own.words)).select(
            "page_id", "host", "path",
            F.when(mine, own.decides(F.col("host"), F.col("words"))).otherwise(F.col("listed")).alias("listed"))
        if s < shards - 1:
            judged = written(judged, "url-pass")
    found = rule_for(F.col("host"), F.col("path"), rules)
    return judged.withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def listed_domains(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(domain): the query's block list, every domain of the corpus from a label
    on that holds one of LISTED_WORDS."""
    host, _ = parts(F.col(url_col).cast("string"))
    return pages.select(host.alias("host")).distinct().select(F.regexp_extract("host", LISTED, 1).alias("domain")).filter(
        "domain <> ''").distinct()


def op12_oracle() -> str:
    """DuckDB SQL of the query: suffix tests against the list itself."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN ['{h}{p}', '{v}']"
        for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
    return rf"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
d AS (SELECT DISTINCT regexp_extract(host, '{LISTED}', 1) AS domain FROM p WHERE regexp_matches(host, '{LISTED}')),
l AS (SELECT DISTINCT host FROM p WHERE EXISTS (
  SELECT 1 FROM d WHERE length(domain) <= {NAME_CHARS} AND (host = domain OR ends_with(host, '.' || domain)))),
f AS (SELECT *, CASE {fits} END AS found FROM p)
SELECT page_id, host, path, found[1] AS rule,
  coalesce(found[2], CASE WHEN host IN (SELECT host FROM l) THEN 'block' ELSE 'allow' END) AS verdict
FROM f"""
