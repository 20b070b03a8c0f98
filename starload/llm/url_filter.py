"""URL verdicts: the longest rule that fits, else exact membership of the host in a list by a Bloom filter cascade."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import written

Rule = tuple[str, str, str]
"""Verdict, host, path prefix."""

FIRST_RATE = 0.01
LATER_RATE = 0.5
MOST_BYTES = 16 << 20
"""Size of a level's filter, which goes to every task; the keys of a longer list are dealt out to several cascades."""
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between ``://`` and the next ``/``, ``?`` or ``#``, A-Z lowered; then up to ``?`` or ``#``. Else empty."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, *_LOWER), F.substring_index(F.substring_index(path, "?", 1), "#", 1)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct(rule, verdict) of the longest rule that fits, null when none does.

    A rule fits its host and every subdomain of it when the path starts with the rule's.
    """
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


class Level:
    """One Bloom filter of the cascade, kept as a written one-row table of 64-bit words."""

    def __init__(self, keys: DataFrame, count: int, rate: float, number: int):
        self.number = number
        self.bits = bits_for(count, rate)
        self.hashes = min(16, max(1, round(self.bits / count * math.log(2))))
        marks = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("place")).select(
            F.floor(F.col("place") / 64).alias("word"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("value")
        )
        blank = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("value"))
        words = marks.unionByName(blank).groupBy("word").agg(F.bit_or("value").alias("value"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("word", "value"))), lambda w: w["value"])
        self.words = written(words.agg(ordered.alias("words")), "url-filter")

    def _places(self, key: Column) -> list[Column]:
        bits = F.lit(self.bits)
        one, two = (F.pmod(h, bits) for h in (F.xxhash64(F.lit(self.number), key), F.xxhash64(key, F.lit(self.number))))
        return [F.pmod(one + F.lit(i) * two, bits) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        """Whether every place of the key is set: true for each key put in, by chance for others."""
        words = self.words.scalar()
        marked = (
            F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
            for p in self._places(key)
        )
        return reduce(lambda a, b: a & b, marked)


def bits_for(count: int, rate: float) -> int:
    return max(64, math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64) * 64)


class Cascade:
    """Exact membership in ``listed(key)`` for every key of ``universe(key)``, both distinct, without a join.

    Level 1 holds the listed keys, level 2 the other keys of the universe that level 1 takes for
    listed, level 3 the listed keys that level 2 takes for those, and so on until a level errs on no
    key. The first level that does not hold a key gives its answer: an odd one says not listed.

    Of the universe only the keys that level 1 holds are compared with the list.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame):
        self.levels: list[Level] = []
        count = listed.count()
        if not count:
            return
        first = Level(listed, count, FIRST_RATE, 1)
        self.levels.append(first)
        passed = written(universe.where(first.holds(F.col("key"))), "url-passed")  # the listed ones and a hundredth of the others
        held = written(passed.join(listed, "key", "left_anti"), "url-wrong")
        other = written(passed.join(listed, "key", "left_semi"), "url-listed")
        number, count = 2, held.count()
        while count:
            level = Level(held, count, LATER_RATE, number)
            self.levels.append(level)
            wrong = written(other.where(level.holds(F.col("key"))), "url-wrong")
            number, held, other, count = number + 1, wrong, held, wrong.count()

    def listed(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(~level.holds(key), level.number % 2 == 0).otherwise(answer)
        return answer


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages(page_id, url, ...)``.

    Without a fitting rule a page is blocked when its host is in ``listed(key)``, a distinct column
    of hosts. A null url, or one without ``://``, has an empty host and path. Repeated rows are kept,
    an empty table gives no rows, an empty list blocks nothing, other columns are ignored. Hosts are dealt out
    by hash to as many cascades as keep each filter within ``MOST_BYTES``: one as a rule; with more, the pages of
    each are judged and written in turn.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = written(parts.select(F.col("host").alias("key")).distinct(), "url-hosts")
    cascades = max(1, -(-bits_for(listed.count(), FIRST_RATE) // (8 * MOST_BYTES)))
    by_rule = longest_rule(rules, F.col("host"), F.col("path"))
    judged = []
    for k in range(cascades):
        mine = lambda rows, key: rows.where(F.pmod(F.xxhash64(F.lit(-1), F.col(key)), F.lit(cascades)) == k) if cascades > 1 else rows  # noqa: B023, E731
        blocked = Cascade(mine(listed, "key"), mine(universe, "key")).listed(F.col("host"))
        verdicts = mine(parts, "host").withColumn("_by", by_rule).select(
            "page_id", "host", "path", F.col("_by.rule").alias("rule"),
            F.coalesce("_by.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        )
        judged.append(verdicts if cascades == 1 else written(verdicts, "url-verdicts"))
    return reduce(DataFrame.unionByName, judged)


def tracking_hosts(pages: DataFrame, mark: str = "utm_source=") -> DataFrame:
    """A list made of the corpus itself: hosts whose urls carry ``mark`` more often than urls do overall."""
    host, _ = host_and_path(F.col("url"))
    per_host = pages.groupBy(host.alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("url").contains(mark)).alias("marked")
    )
    per_host = written(per_host, "url-list")
    urls, marked = per_host.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("marked"), F.lit(0))).first()
    return per_host.where(F.col("marked") * urls > F.col("n") * marked).select("key")
