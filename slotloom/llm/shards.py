"""Shards by sampled splitters: even in bytes, equal texts together.

The key of a row is a hash of its text. A sample of keys is drawn, each row with a chance in proportion to its size, and its
quantiles cut the keys into many ranges of about equal bytes. One grouped pass measures the ranges. Ranges that are overfull
because a single text fills them are subdivided: such a *heavy* key, of which there can be only a few, becomes a
range of its own, dealt into parts by a second hash. Heavy keys go whole to the emptiest shard (part by part only if one exceeds
a shard's share), then the other ranges in order to the room that is left, by the middle of the running sum of bytes; so
shards differ by about a range, and equal texts stay together. Places within a shard are the range's first place plus
the rank within the range or part, so nothing is ranked in one task.

What reaches the driver is the sample and a row per range. Both are bounded by ``RANGES`` and by a range for
every ``RANGE_ROWS`` rows, never by documents' texts.

Defined results: a null text weighs 1 byte, has the checksum of an empty text, and is apart from an empty text; repeated
rows get places of their own; no rows give no shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotloom.session import stage

RANGES, RANGE_ROWS, SAMPLED = 1024, 1_000_000, 24
# A key is heavy from this part of a shard on, and is dealt into parts of about this size.
HEAVY = 1 / 32


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows as ``row`` (a struct of the columns in ``carry``, all by default) with size, text_crc32, law, shard, slot, grown_shard."""
    names = docs.columns if carry is None else carry
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"), F.xxhash64(F.col(f"`{key}`"), F.lit("part")).alias("tie"))
    if docs.select(key).schema[0].dataType.typeName() in ("map", "variant"):
        raise ValueError("the key column must be hashable")
    keyed = stage(rows, "keyed")
    total = keyed.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    n_bytes, n_rows = total["bytes"] or 0, total["rows"]
    ranges = max(RANGES, -(-n_rows // RANGE_ROWS))
    chance = F.least(F.lit(1.0), F.col("size") * (ranges * SAMPLED / max(1, n_bytes)))
    draw = F.pmod(F.xxhash64("key", "tie", "size"), F.lit(1 << 40)) / float(1 << 40)
    sample = np.sort(keyed.where(draw < chance).select("key").toPandas()["key"].to_numpy(np.int64))
    splitters = np.unique(sample[np.arange(1, ranges) * len(sample) // ranges]) if len(sample) else np.zeros(0, np.int64)

    part = n_bytes / shards * HEAVY
    first = keyed.withColumn("range", _range_of(splitters)(F.col("key")))
    full = first.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > part)
    heavy = first.join(F.broadcast(full.select("range")), "range").groupBy("key").agg(F.sum("size").alias("bytes")).where(
        F.col("bytes") > part).toPandas()  # each holds a fixed part of all bytes, so there are few
    keys = heavy["key"].to_numpy(np.int64)
    splitters = np.unique(np.concatenate([splitters, keys, keys[keys < np.iinfo(np.int64).max] + 1]))
    parts = {int(k): int(-(-b // part)) for k, b in zip(heavy["key"], heavy["bytes"])}
    deal = F.lit(0).cast("long")
    for k, n in parts.items():
        deal = F.when(F.col("key") == k, F.pmod("tie", F.lit(n))).otherwise(deal)
    placed = keyed.withColumn("range", _range_of(splitters)(F.col("key"))).withColumn("part", deal)
    table = placed.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas().sort_values(
        ["range", "part"], ignore_index=True)
    own = np.searchsorted(splitters, keys, "right")  # the ranges that are one heavy key
    table["shard"] = _assign(table, set(own.tolist()), n_bytes, shards)
    table["before"] = table.groupby("shard")["rows"].cumsum() - table["rows"]
    order = table["range"].to_numpy(np.int64) * (1 << 20) + table["part"].to_numpy(np.int64)
    shard_of, before = table["shard"].to_numpy(np.int32), table["before"].to_numpy(np.int64)

    @F.pandas_udf("shard int, before long")
    def place(range_: pd.Series, part_: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(order, range_.to_numpy(np.int64) * (1 << 20) + part_.to_numpy(np.int64))
        return pd.DataFrame({"shard": shard_of[at], "before": before[at]})

    rank = F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "tie", "size"))
    return placed.withColumn("rank", rank).withColumn("place", place("range", "part")).select(
        "row", "size", "text_crc32", F.lit("bytes").alias("law"), "place.shard",
        (F.col("place.before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _assign(table: pd.DataFrame, heavy: set[int], n_bytes: int, shards: int) -> np.ndarray:
    """A shard for each measured range: heavy keys whole to the emptiest shard, their parts apart if one
    exceeds a shard's share; then the other ranges in order, so that all shards come out even."""
    share, load = n_bytes / shards, np.zeros(shards)
    out, is_heavy = np.zeros(len(table), dtype=int), table["range"].isin(heavy).to_numpy()
    sizes = table["bytes"].to_numpy(np.float64)
    groups = [g.index.to_numpy() for _, g in table[is_heavy].groupby("range")]
    groups = [x for g in groups for x in ([g] if sizes[g].sum() <= share else [[i] for i in g])]
    for g in sorted(groups, key=lambda g: (-sizes[g].sum(), g[0])):
        out[g] = at = int(np.argmin(load))
        load[at] += sizes[g].sum()
    light = np.flatnonzero(~is_heavy)
    if len(light):
        room = np.maximum(share - load, 0)
        ends = np.cumsum(room) * (sizes[light].sum() / max(room.sum(), 1e-9))
        middle = np.cumsum(sizes[light]) - sizes[light] / 2
        out[light] = np.minimum(np.searchsorted(ends, middle, "left"), shards - 1)
    return out


def _range_of(splitters: np.ndarray):
    @F.pandas_udf("long")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(np.int64), "right"))

    return range_of


def write_shards(sharded: DataFrame, folder: str) -> None:
    """The rows themselves, a folder for each shard, in the order of their places within each file."""
    sharded.select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot")).sortWithinPartitions("_shard", "_slot").write.partitionBy(
        "_shard").parquet(folder)
