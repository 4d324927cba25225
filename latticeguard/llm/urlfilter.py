"""URL filters by a Bloom filter cascade, in DataFrame functions only.

The corpus's complete key universe is known: every host suffix of its URLs, alone and with the path
prefixes that rules can have. A cascade encodes one list over that universe. Its first Bloom filter
holds the listed keys; the second holds the first's false positives among all other keys; the third
the listed keys that the second wrongly holds; and so on until a level has no false positive. A key
is listed if the first level that it fails is an even one. Over the universe that is exact, so URLs
are judged row by row, without a join: the levels are constants of the plan.

A level is as large as the set it encodes, and each set is a small share of the one two before. The
bits gathered for a cascade are checked against `MAX_BITS`; a list beyond that is looked up by an
equi-join of the distinct (host, path) pairs instead, with the same results.
"""
from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import free_name, materialize
from latticeguard.session import release

BITS_PER_KEY = 12
HASHES = 4
#: Most bits that a level may have as a constant of the plan (4 MB).
MAX_BITS = 1 << 25

#: The fixed rules (host/path prefix), and words that name listed hosts.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path up to ? or #.

    A null URL, or one without ://, has an empty host and path.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*+", 0)
    path = F.regexp_extract(rest, "^[^/?#]*+([^?#]*+)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every suffix of the host at a dot with every prefix of the path of the given lengths (that it has)."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    heads = F.filter(F.array(*(F.when(F.length(path) >= n, F.substr(path, F.lit(1), F.lit(n))) for n in lengths)),
                     lambda x: x.isNotNull())
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda h: F.concat(s, h)))))


class Level:
    """One Bloom filter, as words of 64 bits."""

    def __init__(self, number: int, bits: int, words: list[int]):
        self.number, self.bits = number, bits
        self.words = F.from_json(F.lit(json.dumps(words)), "array<bigint>")  # folded into one constant

    @staticmethod
    def places(key: Column, number: int, bits: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits)) for i in range(HASHES)]

    def holds(self, key: Column) -> Column:
        found = [F.getbit(F.get(self.words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1
                 for at in self.places(key, self.number, self.bits)]
        all_found = found[0]
        for one in found[1:]:
            all_found = all_found & one
        return all_found


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            listed = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(listed)
        return listed


def build(universe: DataFrame, listed: DataFrame, max_bits: int = MAX_BITS) -> Cascade | None:
    """The cascade of `listed.key` over `universe.key` (distinct keys); None if a level would exceed `max_bits`."""
    flag = listed.select("key").distinct().withColumn("listed", F.lit(True))
    marked = materialize(universe.select("key").join(flag, "key", "left"), "cascade-universe")
    inside, outside = marked.where("listed").select("key"), marked.where("listed IS NULL").select("key")
    levels, written = [], [marked]
    while count := inside.count():
        bits = 1 << max(6, (count * BITS_PER_KEY - 1).bit_length())
        if bits > max_bits:
            return None
        number = len(levels) + 1
        at = F.explode(F.array(*Level.places(F.col("key"), number, bits)))
        words = (inside.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).cast("int").alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, int(at % 64))")).alias("bits")).collect())
        dense = [0] * (bits // 64)
        for row in words:
            dense[row["word"]] = row["bits"]
        levels.append(Level(number, bits, dense))
        wrong = materialize(outside.where(levels[-1].holds(F.col("key"))), "cascade-level")
        written.append(wrong)
        inside, outside = wrong, inside
    for table in written:
        release(table)
    return Cascade(levels)


def _joined(parts: DataFrame, candidates: Column, lists: dict[str, DataFrame]) -> DataFrame:
    """The matched keys of each list by an equi-join: for lists too large for a cascade."""
    pairs = materialize(parts.select("host", "path").distinct(), "url-pairs")
    found = pairs
    for name, listed in lists.items():
        hits = (pairs.select("host", "path", F.explode(candidates).alias("key")).join(listed.select("key").distinct(), "key")
                .groupBy("host", "path").agg(F.collect_list("key").alias(name)))
        found = found.join(hits, ["host", "path"], "left")
    none = F.array().cast("array<string>")
    found = materialize(found.select("host", "path", *(F.coalesce(n, none).alias(n) for n in lists)), "url-hits")
    return parts.join(found, ["host", "path"], "left")


def judge(pages: DataFrame, lists: dict[str, DataFrame], url: str = "url", lengths: Sequence[int] = (0, 1),
          max_bits: int = MAX_BITS) -> DataFrame:
    """`pages` with host, path and, for each list, an array column of the keys of it that fit the URL.

    `lists` maps a name to a table of keys; a key is a host suffix followed by a path prefix of one
    of the `lengths`. A null URL has an empty host and path, and fits only keys of those. Repeated
    rows are judged alike; an empty table gives no rows. New columns get an underscore in front
    where `pages` has their name already.
    """
    host, path = url_parts(F.col(url))
    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row")
    parts = pages.select(row, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    candidates = keys(F.col("host"), F.col("path"), lengths)
    universe = materialize(parts.select(F.explode(candidates).alias("key")).distinct(), "url-universe")
    cascades = {name: build(universe, listed, max_bits) for name, listed in lists.items()}
    if all(cascades.values()):
        hit: Callable[[str], Column] = lambda name: F.filter("candidates", cascades[name].lists)
        made = F.array(F.struct(candidates.alias("candidates")))
        judged = parts.select("*", F.inline(made)).select("row", "host", "path", *(hit(n).alias(n) for n in lists))
    else:
        judged = _joined(parts, candidates, lists)
    taken = {n: free_name(pages, n) for n in ("host", "path", *lists)}
    return judged.select("row.*", *(F.col(n).alias(a) for n, a in taken.items()))


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], listed: DataFrame, url: str = "url",
             max_bits: int = MAX_BITS) -> DataFrame:
    """`pages` with host, path, rule and verdict: the longest fitting rule's, else block for listed hosts.

    `rules` are (allow or block, host/path prefix); `listed.key` are hosts, which stand for their
    subdomains too. Of two fitting rules of one length, that with the longer host wins.
    """
    spark = pages.sparkSession
    lengths = sorted({0, *(len(r) - r.index("/") for _, r in rules)})
    tables = {f"{v}_keys": spark.range(1).select(F.explode(F.array(*(F.lit(r) for w, r in rules if w == v)).cast(
        "array<string>")).alias("key")) for v in ("allow", "block")}
    names = {n: free_name(pages, n) for n in ("host", "path", "allow_keys", "block_keys", "listed_keys")}
    judged = judge(pages, {**tables, "listed_keys": listed}, url, lengths, max_bits)

    def ranked(name: str, verdict: str) -> Column:
        return F.transform(F.col(names[name]), lambda k: F.struct(
            F.length(k).alias("n"), F.instr(k, "/").alias("h"), F.lit(verdict).alias("verdict"), k.alias("rule")))

    best = F.array_max(F.concat(ranked("allow_keys", "allow"), ranked("block_keys", "block")))
    otherwise = F.when(F.size(names["listed_keys"]) > 0, "block").otherwise("allow")
    winner = free_name(judged, "best")
    return judged.withColumn(winner, best).select(
        *(F.col(f"`{c}`") for c in pages.columns), names["host"], names["path"],
        F.col(f"{winner}.rule").alias(free_name(pages, "rule")),
        F.coalesce(F.col(f"{winner}.verdict"), otherwise).alias(free_name(pages, "verdict")))


def listed_hosts(pages: DataFrame, url: str = "url", words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """(key): host suffixes of the corpus, two labels at least, whose first label has a listed word between hyphens."""
    host, _ = url_parts(F.col(url))
    pattern = rf"^(?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\."
    return (pages.select(host.alias("host")).distinct().select(F.explode(keys(F.col("host"), F.lit(""), [0])).alias("key"))
            .where(F.col("key").rlike(pattern)).distinct())
