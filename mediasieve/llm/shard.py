"""Sharding by a hypergeometric communication matrix.

A uniform shuffle with exact shard sizes, without moving the rows to count them: how many rows of each partition go to
each shard is drawn as it would fall out for a random order of all rows (hypergeometric, a row of the matrix after the
other). Inside a partition the rows are put in random order, by hash, and the first of them go to the first shard, and
so on; the order of a shard is permuted again after the exchange. Partitions are virtual, by a hash of the key, so a
lost task deals its rows out again in the same way.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, settle

#: Rows of a partition and their most; rows of a bucket of a shard and their most.
PART_ROWS, MOST_PARTS = 20_000, 4096
BUCKET_ROWS, MOST_BUCKETS = 1000, 8192
#: Above this population the generator's own hypergeometric draw isn't available.
_EXACT_BELOW = 10**9


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of draws rows out of good + bad are good."""
    if not draws or not good:
        return 0
    if not bad:
        return draws
    if good + bad < _EXACT_BELOW:
        return int(rng.hypergeometric(good, bad, draws))
    # Inversion from the mode outwards, with ratios of neighbouring probabilities.
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    at = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    u, up, down, i, j = rng.random() - at, at, at, mode, mode
    while u > 0 and (up > 0 or down > 0):
        up = up * (good - i) * (draws - i) / ((i + 1) * (bad - draws + i + 1)) if i < high else 0.0
        i += up > 0
        if up and (u := u - up) <= 0:
            return i
        down = down * j * (bad - draws + j) / ((good - j + 1) * (draws - j + 1)) if j > low else 0.0
        j -= down > 0
        if down and (u := u - down) <= 0:
            return j
    return mode


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> np.ndarray:
    """How many rows of each partition go to each shard; rows sum to parts and columns to shards."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out, room = np.zeros((len(parts), len(shards)), np.int64), list(shards)
    for p, rows in enumerate(parts):
        rest = sum(room)
        for s in range(len(shards)):
            rest -= room[s]
            n = hypergeometric(room[s], rest, rows, rng)
            out[p, s] = n
            room[s] -= n
            rows -= n
    return out


def _keyed(df: DataFrame, keys: list[str], seed: int, parts: int) -> tuple[DataFrame, Column]:
    part = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(parts)).cast("int")
    return df.withColumn("_part", part).withColumn("_first", F.xxhash64(F.lit(seed + 1), *keys)), part


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with _n, counted from 1 for each key, however many of them share it: numbers of the whole order, less where a key begins."""
    own = ranked(rows.withColumn("_at", F.monotonically_increasing_id()), "_part", "_first", "_at", name="_n").drop("_at")
    own = settle(own)
    begins = own.groupBy("_part", "_first").agg((F.min("_n") - 1).alias("_lo"))  # keys that a cut goes through
    return own.join(F.broadcast(begins), ["_part", "_first"]).withColumn("_n", F.col("_n") - F.col("_lo")).drop("_lo")


def _dealt(keyed: DataFrame, cuts: DataFrame, split: DataFrame | None) -> DataFrame:
    """keyed with shard, by the cuts of its partition, and _n, 0; keys that a cut goes through are dealt by count, _n."""
    by_cut = F.size(F.filter(F.col("_cuts"), lambda c: c <= F.col("_first"))).cast("int")
    keyed = keyed.join(F.broadcast(cuts), "_part", "left").withColumn("_cuts", F.coalesce("_cuts", F.array().cast("array<bigint>")))
    none = F.lit(0).cast("long")
    if split is None:
        return keyed.withColumn("shard", by_cut).withColumn("_n", none).drop("_cuts")
    joined = keyed.join(F.broadcast(split), ["_part", "_first"], "left")
    plain = joined.where("_ends is null").withColumn("shard", by_cut).withColumn("_n", none)
    shared = _numbered(joined.where("_ends is not null"))
    shared = shared.withColumn("shard", F.size(F.filter(F.col("_ends"), lambda e: e < F.col("_n"))).cast("int"))
    return plain.unionByName(shared).drop("_cuts", "_ends")


def sharded(df: DataFrame, keys: list[str], n_shards: int = 16, seed: int = 11) -> DataFrame:
    """df with shard and slot: shards of rows at most one apart, filled in uniformly random order; slots run from 0 without gaps.

    The order comes from hashes of keys alone, so only they are read before the one exchange that moves whole rows. Rows
    whose keys are equal, or all null, are told apart by count, and their order in a shard is by the hash of the row. An
    empty table gives no rows. Columns of df called shard or slot are replaced.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("shard", "slot")]
    plain = [f"_k{n}" for n in range(len(keys))]
    narrow = df.select(*[F.col(k).alias(n) for k, n in zip(keys, plain, strict=True)])
    total = narrow.count()
    parts = min(MOST_PARTS, max(1, -(-total // PART_ROWS)))
    buckets = min(MOST_BUCKETS, max(1, -(-total // (n_shards * BUCKET_ROWS))))
    first, _ = _keyed(narrow, plain, seed, parts)
    ranks = settle(first.groupBy("_part", "_first").count())
    rows = {r[0]: r[1] for r in ranks.groupBy("_part").agg(F.sum("count")).collect()}  # one row a partition, MOST_PARTS at most
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([rows.get(p, 0) for p in range(parts)], sizes, seed)
    ends = spark.createDataFrame([(p, np.cumsum(matrix[p]).tolist()) for p in range(parts)], "_part int, _to array<bigint>")
    # The keys before and after each cut, in the order of the partition.
    order = Window.partitionBy("_part").orderBy("_first")
    before = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("count")
    placed = ranks.withColumn("_before", before).join(F.broadcast(ends), "_part")
    # Cut s lies at the first key whose place is at or behind the end of shard s; no such key: behind all.
    cut_at = placed.select("_part", "_first", "_before", "count", F.posexplode("_to").alias("_shard", "_end")).where(f"_shard < {n_shards - 1}")
    cuts = cut_at.groupBy("_part", "_shard").agg(F.min(F.when(F.col("_before") >= F.col("_end"), F.col("_first"))).alias("_cut"))
    # A missing cut can't be compared: it is left out, and so sends nothing further.
    cuts = cuts.groupBy("_part").agg(F.array_compact(F.transform(F.array_sort(F.collect_list(F.struct("_shard", "_cut"))), lambda x: x["_cut"])).alias("_cuts"))
    through = cut_at.where((F.col("_before") < F.col("_end")) & (F.col("_before") + F.col("count") > F.col("_end")))
    split = through.select("_part", "_first").distinct().join(placed.select("_part", "_first", "_before", "_to"), ["_part", "_first"])
    split = settle(split.select("_part", "_first", F.transform(F.slice("_to", 1, n_shards - 1), lambda e: e - F.col("_before")).alias("_ends")))
    cuts = settle(cuts)
    shared = None if split.isEmpty() else split  # n_shards - 1 a partition at most

    def bucketed(frame: DataFrame) -> DataFrame:
        second = F.xxhash64(F.lit(seed + 2), *plain, "_n")  # _n parts the rows of one key
        return frame.withColumn("_second", second).withColumn("_bucket", F.pmod(F.shiftrightunsigned(F.col("_second"), 8), F.lit(buckets)).cast("int"))

    counts = bucketed(_dealt(first, cuts, shared)).groupBy("shard", "_bucket").count()
    counts = settle(counts)  # a row for each bucket of a shard
    ahead = counts.withColumn("_ahead", F.sum("count").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("count")).drop("count")
    whole, _ = _keyed(df.select(*[F.col(k).alias(n) for k, n in zip(keys, plain, strict=True)], F.struct(*names).alias("_row")), plain, seed, parts)
    out = bucketed(_dealt(whole, cuts, shared))
    order = Window.partitionBy("shard", "_bucket").orderBy("_second", F.xxhash64("_row"))
    out = out.withColumn("_place", F.row_number().over(order)).join(F.broadcast(ahead), ["shard", "_bucket"])
    return out.select("_row.*", "shard", (F.col("_ahead") + F.col("_place") - 1).alias("slot"))


def result(df: DataFrame) -> DataFrame:
    """The contract's columns; a null text has no bytes. Copies of a text are shuffled like any rows: equal shard sizes leave no room to keep a hot group together."""
    out = sharded(df.select("doc_id", "text"), ["doc_id"])
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
