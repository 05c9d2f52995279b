"""Allow and block rules for urls as a sort-merge range join.

A rule names a host, with all its subdomains, and the beginning of a path; the longest rule that fits
a url decides. A url gets one canonical key for every rule depth (number of host labels that some
rule has): the last labels of its host in reversed order, then its path. A rule's key is its reversed
host and its path, so that the urls it fits are those with a key in one interval, from the rule's
key up to its successor among strings of that length; intervals are nested or disjoint.

Keys are dealt out by ranges with fixed borders from a sample. A rule goes to every range that its
interval touches, a url key to one; a key that fills several ranges spreads over them. In each range
one sweep over the sorted keys holds the stack of active nested rules. The answers for a url's depths
merge by url in an aggregate with map-side combine. Only the borders are broadcast, one key for each range, from
a sample of at most ``MOST`` keys.

Urls are read literally: the host runs from after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A-Z in lower case, the path from there up to ``?``, ``#`` or the end. A null url and one without
``://`` have an empty host and path and fit no rule. A rule without a host is left out, a null
path is an empty one. Repeated rules count once; of two verdicts for
the same rule ``block`` wins.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import partitions

#: Keys sampled for each range to place the borders, and at most in all; they decide balance, not results.
SAMPLE, MOST = 60, 200_000


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return _part(url, 2)


def _part(url: Column, i: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))


def _key(labels: Column, n: Column, url_path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.slice(labels, -n, n)), "."), F.lit("/"), url_path)


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", ranges: int | None = None) -> DataFrame:
    """Append host, path, rule (host and path of the longest fitting rule, else null) and verdict.

    ``rules``: host, path, verdict. Columns of those four names in ``urls`` are replaced; all others
    are kept. Rows with equal urls are judged once and all of them are returned.
    """
    spark = urls.sparkSession
    ranges = ranges or partitions(spark)
    rules = rules.where("host is not null").groupBy(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path")).agg(F.max("verdict").alias("verdict"))
    labels = F.split("host", r"\.")
    rules = rules.select(F.concat("host", "path").alias("rule"), "verdict", F.size(labels).alias("depth"),
                         _key(labels, F.size(labels), F.col("path")).alias("key"))
    depths = sorted(r.depth for r in rules.select("depth").distinct().collect())  # label counts: 127 at most
    new = ("host", "path", "rule", "verdict")
    kept = urls.select(*[f"`{c}`" for c in urls.columns if c.lower() not in new], F.col(url).alias("url to judge"))
    parts = kept.withColumn("host", host(F.col("url to judge"))).withColumn("path", path(F.col("url to judge")))
    distinct = parts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).where("host <> ''")
    at = F.explode(F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>"))
    keys = distinct.select("host", "path", F.split("host", r"\.").alias("labels"), at.alias("depth")) \
        .where(F.size("labels") >= F.col("depth")) \
        .select("host", "path", _key(F.col("labels"), F.col("depth"), F.col("path")).alias("key"))
    found = _sweep(keys, rules, ranges)
    longest = found.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("best"))
    # Hot urls: the answers are one row per distinct url, and adaptive execution splits a hot host's rows.
    return parts.join(longest, ["host", "path"], "left").select(
        *[f"`{c}`" for c in kept.columns[:-1]], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def _successor(key: str) -> str:
    """The first string after all that begin with ``key``."""
    key = key.rstrip("\U0010ffff")
    return key[:-1] + chr(ord(key[-1]) + 1 if key[-1] != "\ud7ff" else 0xE000)


def _sweep(keys: DataFrame, rules: DataFrame, ranges: int) -> DataFrame:
    n = min(SAMPLE * ranges, MOST)
    sample = keys.select("key", F.xxhash64("host", "path").alias("h")).orderBy("h").limit(n).select("key").toPandas()["key"]
    ordered = sorted(sample)
    shared = keys.sparkSession.sparkContext.broadcast([ordered[i * len(ordered) // ranges] for i in range(1, ranges)] if ordered else [])

    def deal(batches: Iterable[pa.RecordBatch]):
        """The ranges of each row: of a url's key one, of a rule's interval all that it touches."""
        borders = shared.value
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for key, kind, a, c in zip(*(col.to_pylist() for col in b.columns), strict=True):
                first, last = bisect.bisect_left(borders, key), bisect.bisect_right(borders, key)
                if kind == 0:
                    last = bisect.bisect_left(borders, _successor(key))
                else:  # a key that fills several ranges spreads over them
                    first = last = first + zlib.crc32(a.encode()) % (last - first + 1)
                for r in range(first, last + 1):
                    for column, value in zip(out, (r, key, kind, a, c), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                                              pa.array(out[3], pa.string()), pa.array(out[4], pa.string())],
                                             ["range", "key", "kind", "a", "b"])

    def sweep(batches: Iterable[pa.RecordBatch]):
        """Rows come by range and key, a rule before the urls with its own key."""
        stack: list[tuple[str, str, str]] = []
        now = None
        for b in batches:
            hosts, paths, found, verdicts = [], [], [], []
            for r, key, kind, x, y in zip(*(col.to_pylist() for col in b.columns), strict=True):
                if r != now:
                    now, stack = r, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, x, y))
                elif stack:
                    hosts.append(x)
                    paths.append(y)
                    found.append(stack[-1][1])
                    verdicts.append(stack[-1][2])
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in (hosts, paths, found, verdicts)],
                                             ["host", "path", "rule", "verdict"])

    rows = rules.select("key", F.lit(0).alias("kind"), F.col("rule").alias("a"), F.col("verdict").alias("b")).unionByName(
        keys.select("key", F.lit(1).alias("kind"), F.col("host").alias("a"), F.col("path").alias("b")))
    dealt = rows.mapInArrow(deal, "range int, key string, kind int, a string, b string")
    return dealt.repartition(ranges, "range").sortWithinPartitions("range", "key", "kind") \
        .mapInArrow(sweep, "host string, path string, rule string, verdict string")
