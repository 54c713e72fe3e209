"""Clustering inside groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import settle


def cluster_within(df: DataFrame, group: str, key: str, vector: str, order: list, k: int = 5, seed: int = 42, rounds: int = 50) -> DataFrame:
    """df with cluster_id.

    Groups of at most k rows: each row its own, 0 and up in order. Larger ones: k-means over standardised vectors. A
    null vector has cluster -1; a group without any vectors has 0 throughout. Mean, scale and centres come from all
    rows, in sums by group and cluster; only the centres of all groups meet their rows, in a join.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count(vector).alias("_with"))
    rows = df.join(sizes.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    few = rows.where(F.col("_n") <= k).withColumn("cluster_id", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long") - 1)
    none = rows.where((F.col("_n") > k) & (F.col("_with") == 0)).withColumn("cluster_id", F.lit(0).cast("long"))
    many = rows.where((F.col("_n") > k) & (F.col("_with") > 0))
    own = many.where(F.col(vector).isNotNull()).select(F.col(group).alias("_g"), F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_v"))
    means = own.select("_g", F.posexplode("_v").alias("_d", "_x")).groupBy("_g", "_d").agg(F.avg("_x").alias("_m"), F.stddev_pop("_x").alias("_s"))
    scale = F.when(F.col("_s") > 0, F.col("_s")).otherwise(1.0)
    by = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("_d", c.alias("c")))), lambda x: x["c"])
    moments = settle(means.groupBy("_g").agg(by(F.col("_m")).alias("_mean"), by(scale).alias("_scale")))
    met = lambda a, b: a.join(b.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h"))).drop("_h")
    z = F.zip_with(F.zip_with("_v", "_mean", lambda x, m: x - m), "_scale", lambda x, s: x / s)
    v = settle(met(own, moments).select("_g", "_key", z.alias("_z")))

    @F.pandas_udf("long")
    def nearest(z: pd.Series, spots: pd.Series) -> pd.Series:
        return pd.Series([-1 if x is None else int(np.argmin(((np.stack(c) - x) ** 2).sum(1))) for x, c in zip(z, spots, strict=True)], dtype="int64")

    @F.pandas_udf("double")
    def away(z: pd.Series, spots: pd.Series) -> pd.Series:
        return pd.Series([float(((np.stack(c) - x) ** 2).sum(1).min()) for x, c in zip(z, spots, strict=True)], dtype="float64")

    # k-means++ over all rows: the least of exponential draws, each over its weight, falls on a row as often as its weight says.
    spots = None
    for n in range(k):
        draw = -F.log((F.pmod(F.xxhash64("_key", F.lit(seed), F.lit(n)), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1)))
        far = F.lit(1.0) if spots is None else away("_z", "_spots")
        at = v if spots is None else met(v, spots)
        at = at.withColumn("_far", far)
        order_of = F.struct(F.when(F.col("_far") > 0, draw / F.col("_far")).otherwise(F.lit(float("inf"))), "_key")
        new = at.groupBy("_g").agg(F.min_by("_z", order_of).alias("_new"))
        spots = settle(new.select("_g", F.array("_new").alias("_spots")) if spots is None else met(new, spots).select("_g", F.concat("_spots", F.array("_new")).alias("_spots")))

    def assigned(centres: DataFrame) -> DataFrame:
        return met(v, centres).withColumn("_c", nearest("_z", "_spots"))

    for _ in range(rounds):
        sums = assigned(spots).select("_g", "_c", F.posexplode("_z").alias("_d", "_x")).groupBy("_g", "_c", "_d").agg(F.avg("_x").alias("_m"))
        moved = sums.groupBy("_g", "_c").agg(by(F.col("_m")).alias("_to")).groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_to"))).alias("_found"))
        # A centre without rows stays where it is.
        new = F.transform("_spots", lambda s, i: F.coalesce(F.col("_found")[i.cast("long")], s))
        after = settle(spots.join(moved.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h"))).select("_g", new.alias("_spots"), F.col("_spots").alias("_was")))
        step = F.aggregate(F.flatten(F.zip_with("_spots", "_was", lambda a, b: F.zip_with(a, b, lambda x, y: F.abs(x - y)))), F.lit(0.0), lambda s, x: F.greatest(s, x))
        still = after.where(step > 1e-9).isEmpty()
        spots = after.select("_g", "_spots")
        if still:
            break
    out = met(many.withColumns({"_g": F.col(group), "_v": F.col(vector).cast("array<double>")}), moments)
    out = met(out, spots).withColumn("cluster_id", nearest(z, "_spots"))
    columns = [*df.columns, "cluster_id"]
    return few.select(*columns).unionByName(none.select(*columns)).unionByName(out.select(*columns))


def cluster_counts(df: DataFrame, group: str, cluster: str = "cluster_id") -> DataFrame:
    """Distinct valid clusters over all groups."""
    return df.where(F.col(cluster) >= 0).agg(F.count_distinct(group, cluster).alias("n"))
