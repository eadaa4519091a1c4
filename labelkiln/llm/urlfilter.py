"""URL allow and block rules as a sort-merge range join.

A rule is a host and a path prefix; it fits the host itself and all its
subdomains.  The key of a URL is its reversed host (``com.example.``), a
separator and its path, so a rule is the interval of keys that start with
its own key.  For a rule on a parent host, a URL is also looked up under
each of its parent hosts, which gives a few probes a URL, each a plain
prefix question.

Rules and probes (distinct host and path, so a popular URL costs one row)
are range-partitioned and sorted together; each partition is swept once
with a stack of the rules whose interval is open, whose top is the
longest rule of the probe's host.  Rules opened in an earlier partition
are the rules that are prefixes of the partition's first key; they are
found by joining the prefixes of those few keys to the rules.  The
longest fitting rule over a URL's probes wins: by characters of host and
path, then by the longer host, then block before allow.

Edge cases: null or malformed urls (no ``://``) have empty host and path
and fit no rule; a URL without a path fits only rules with an empty path;
without a rule the default verdict holds (allow); repeated rules count
once, a rule listed both ways blocks; repeated pages each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from .common import pylist

#: Stands between host and path; sorts before every character of a URL that Spark reads as text.
SEPARATOR = "\x01"


def host_of(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty if there is none."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the top level down, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _probes(urls: DataFrame) -> DataFrame:
    """One row per distinct (host, path) and parent host (the host itself included)."""
    labels = F.reverse(F.split("host", r"\."))
    levels = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."), F.lit(SEPARATOR)))
    return urls.where("host <> ''").select("host", "path", F.explode(levels).alias("stem")).select(
        F.concat("stem", "path").alias("key"), F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict"))


def _sweep(batches: Iterator[pa.RecordBatch], opened: dict[int, list[tuple[str, str, str]]]) -> Iterator[pa.RecordBatch]:
    """Sweep one partition, sorted by key with rules first; ``opened`` lists the rules open where a partition begins."""
    stack: list[tuple[str, str, str]] | None = None
    for b in batches:
        keys, kinds, hosts, paths, verdicts, parts = (pylist(b, n) for n in ("key", "kind", "host", "path", "verdict", "part"))
        if stack is None and parts:
            stack = sorted(opened.get(parts[0], []))
        out: list[tuple[str, str, str, str]] = []
        for key, kind, host, path, verdict in zip(keys, kinds, hosts, paths, verdicts):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, host + path, verdict))
            elif stack:
                out.append((host, path, *stack[-1][1:]))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in range(4)],
                                         names=["host", "path", "rule", "verdict"])


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct ``urls`` (host, path) that some rule (host, path, verdict) fits."""
    opened = (rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
              .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' after 'allow'
              .select(F.concat(host_key(F.col("host")), F.lit(SEPARATOR), "path").alias("key"), F.lit(0).alias("kind"), "host", "path", "verdict"))
    rows = opened.union(_probes(urls))
    order = ["key", "kind", "host", "path"]
    ensure_checkpoint_dir(urls.sparkSession)
    # a checkpoint keeps the sorted partitions as they are, so each can be swept without another shuffle
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).checkpoint()
    first = rows.groupBy("part").agg(F.min("key").alias("first"))  # one row per partition
    prefixes = first.select("part", F.explode(F.sequence(F.lit(1), F.length("first"))).alias("n"), "first").select(
        "part", F.expr("substring(first, 1, n)").alias("prefix"))
    carried = (rows.where("kind = 0").select(F.col("part").alias("home"), "key", F.concat("host", "path").alias("rule"), "verdict")
               .join(prefixes, F.col("key") == F.col("prefix")).where("home < part").select("part", "key", "rule", "verdict"))
    opened: dict[int, list[tuple[str, str, str]]] = {}
    for r in carried.collect():  # per partition, the few rules nested around its first key
        opened.setdefault(r["part"], []).append((r["key"], r["rule"], r["verdict"]))
    shared = urls.sparkSession.sparkContext.broadcast(opened)
    found = rows.mapInArrow(lambda batches: _sweep(batches, shared.value), "host string, path string, rule string, verdict string")
    best = F.struct(F.length("rule"), F.length("host"), "verdict", "rule")
    return found.groupBy("host", "path").agg(F.max(best).alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
          default: str = "allow") -> DataFrame:
    """Columns ``keep`` of every page with ``host``, ``path``, the winning ``rule`` (null if none) and ``verdict``."""
    rows = pages.select(*[f"`{c}`" for c in keep], host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = longest_rules(rows.select("host", "path").distinct(), rules)
    return rows.join(found, ["host", "path"], "left").select(
        *keep, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
