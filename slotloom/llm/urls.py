"""URL filters: prefix rules as intervals of reversed-host keys, found by a sorted sweep. DataFrame functions only.

A rule is (host, path, verdict). It fits its host and all subdomains if the URL's path starts with the rule's;
the longest rule (host and path together) wins.

*Keys.* ``www.example.org`` with path ``/en/1`` has the keys ``org//en/1``, ``org.example//en/1`` and
``org.example.www//en/1``: its reversed host, cut at each label, a slash, and the path. A rule fits if its own key is a
prefix of one of them, so a rule is an interval of sorted keys, and intervals nest or are apart.

*Sweep.* Distinct keys and rules are cut into ranges at sampled splitters. A rule goes to every range that its interval
touches and carries its stack: the rules around it, itself on top. Within a range, in key order, the last rule's stack is
carried forward; what of it is still open is what the key starts with, and the innermost of these is the rule.
Then the longest over a URL's keys is its rule. URLs that occur often are swept once.

Defined results: a URL that is null or has no ``://`` has an empty host and path and gets the default verdict; of rules
with the same host and path block wins; of rules of equal length that fit, the first in order of text wins.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Ranges of keys: one for so many keys, within these bounds; so many sampled keys for each.
RANGE_KEYS, LEAST_RANGES, MOST_RANGES, SAMPLED = 50_000, 64, 4096, 32


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null and for a URL without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table (host, path, verdict)."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _splitters(keys: DataFrame) -> list[str]:
    """Keys that cut the sorted keys into even ranges; their number is bounded."""
    n = keys.count()
    ranges = min(MOST_RANGES, max(LEAST_RANGES, n // RANGE_KEYS))
    share = min(1.0, ranges * SAMPLED / max(1, n))
    drawn = sorted(r["key"] for r in keys.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).collect())
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []


def _range_of(key: Column, splitters: list[str], step: int = 64) -> Column:
    """How many splitters are not above the key, looked up in two steps."""
    if not splitters:
        return F.lit(0)
    coarse = F.array(*[F.lit(s) for s in splitters[::step]])
    upper = F.size(F.filter(coarse, lambda x: x <= key))
    blocks = F.array(*[F.array(*[F.lit(s) for s in splitters[i:i + step]]) for i in range(0, len(splitters), step)])
    within = F.size(F.filter(F.element_at(blocks, F.greatest(upper, F.lit(1))), lambda x: x <= key))
    return F.when(upper == 0, 0).otherwise((upper - 1) * step + within)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Each row of ``pages`` as ``row``, with host, path, rule (host and path of the rule that decides, or null) and verdict."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"))
    rules = rules.where("host <> ''").withColumn("labels", _labels(F.col("host")))
    rules = rules.select(
        _key(F.col("labels"), F.col("path")).alias("key"), F.size("labels").alias("depth"),
        _key(F.col("labels"), F.lit("")).alias("stem"), F.concat("host", "path").alias("rule"), "path", "verdict",
    ).groupBy("key", "depth", "stem", "rule", "path").agg(F.max("verdict").alias("verdict"))
    rules = stage(rules, "rules")
    depth = rules.agg(F.max("depth").alias("n")).first()["n"] or 0

    # what is around a rule: the rules whose key is a prefix of its own
    around = rules.select("key", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda i: F.concat("stem", F.substring(F.col("path"), F.lit(1), i)))).alias("outer"))
    entry = F.struct(F.length("rule").alias("size"), F.col("key"), F.col("rule"), F.col("verdict")).alias("entry")
    stacks = around.join(rules.select(F.col("key").alias("outer"), entry), "outer").groupBy("key").agg(
        F.array_sort(F.collect_list("entry")).alias("stack"))

    # deeper cuts than any rule's host can match none
    distinct = stage(rows.where("host <> ''").select("host", "path").distinct(), "urls")
    labels = _labels(F.col("host"))
    cut = distinct.withColumn("labels", labels).select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, depth)))),
        lambda i: _key(F.slice("labels", F.lit(1), i), F.col("path")))).alias("key"))
    keys = stage(cut.select("key").distinct(), "keys")
    splitters = _splitters(keys)
    last = F.size(F.filter(F.array(*[F.lit(s) for s in splitters]), lambda x: (x <= F.col("key")) | x.startswith(F.col("key")))) if splitters else F.lit(0)
    points = keys.select("key", _range_of(F.col("key"), splitters).alias("range"), F.lit(1).alias("kind"), F.lit(None).alias("stack"))
    opened = stacks.select("key", F.explode(F.sequence(_range_of(F.col("key"), splitters), last)).alias("range"), F.lit(0).alias("kind"), "stack")
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = opened.unionByName(points.withColumn("stack", F.col("stack").cast(opened.schema["stack"].dataType))).withColumn(
        "stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    still = F.filter("stack", lambda r: F.col("key").startswith(r["key"]))
    swept = stage(swept.select("key", F.element_at(F.when(F.size(still) > 0, still), -1).alias("entry")).where("entry is not null"), "swept")
    decided = stage(cut.join(swept, "key").groupBy("host", "path").agg(
        F.min(F.struct((-F.col("entry.size")).alias("size"), F.col("entry.rule").alias("rule"), F.col("entry.verdict").alias("verdict"))).alias("best")
    ).select("host", "path", "best.rule", "best.verdict"), "decided")
    return rows.join(decided, ["host", "path"], "left").select(
        "row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
