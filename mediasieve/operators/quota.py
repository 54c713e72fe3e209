"""Quotas by priority, hash samples, splits and pages; all by ranks that no single task computes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import first_rows, ranked


def hash_order(key: str, seed: int = 42) -> Column:
    """An order that every engine can reproduce: md5 of key and seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary"))


def priority_quota(df: DataFrame, priority: Column, target: int, key: str, sampled: int | None = None, seed: int = 42) -> DataFrame:
    """The first target rows by priority (lower first) and key; rows of the priority sampled in hash order instead."""
    own = df.withColumn("_pr", priority).where("_pr is not null")
    tie = F.when(F.col("_pr") == sampled, hash_order(key, seed)).otherwise("") if sampled is not None else F.lit("")
    return ranked(own.withColumn("_tie", tie), "_pr", "_tie", key, name="place").where(F.col("place") <= target).drop("_pr", "_tie")


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows at random, the same for the same keys."""
    return first_rows(df.withColumn("_h", hash_order(key, seed)), n, "_h", key).drop("_h")


def pages(df: DataFrame, order: str, per_row: int = 5, rows: int = 5) -> DataFrame:
    """df with page, row and col of contact sheets, from 0."""
    size = per_row * rows
    at = F.col("_place") - 1
    out = ranked(df, order, name="_place").withColumns({"page": F.floor(at / size).cast("long"), "row": F.floor(at % size / per_row).cast("long"), "col": (at % per_row).cast("long")})
    return out.drop("_place")


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.1, valid: float = 0.1, seed: int = 42) -> DataFrame:
    """df with split: in each label, in hash order, the first share is test, the next valid, the rest train. Shares round half up."""
    own = ranked(df.dropna(subset=[label]).withColumn("_h", hash_order(key, seed)), label, "_h", key, name="_place")
    sizes = own.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"), (F.min("_place") - 1).alias("_before"))
    at = F.col("_place") - F.col("_before")
    a = F.floor(F.col("_n") * test + 0.5)
    b = a + F.floor(F.col("_n") * valid + 0.5)
    return own.join(sizes, own[label] == F.col("_l")).withColumn("split", F.when(at <= a, "test").when(at <= b, "valid").otherwise("train")).drop("_h", "_place", "_l", "_n", "_before")


def shuffled(df: DataFrame, key: str, epoch: int, seed: int = 42) -> DataFrame:
    """Rows in an order that is random anew each epoch and the same each time it is asked for."""
    return df.withColumn("_h", hash_order(key, seed + epoch)).orderBy("_h", key).drop("_h")
