"""Diversity-aware balancing of groups: cap, one of each cluster, scored backfill, trim.

Ranks within a group come from ranks over the whole table, so a group of any size is spread over tasks. Order is total:
score, then salience, then the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BALANCE
from ..storage import first_rows, ranked, ranked_within, settle
from .hygiene import count_by, keep_first


def _best(score: str, salience: str, key: str) -> list[Column]:
    return [F.desc_nulls_last(score), F.desc_nulls_last(salience), F.asc(key)]


def capped(df: DataFrame, group: str, cap: int, order: list[Column]) -> DataFrame:
    """The first cap rows of each group; groups of null are left out."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.dropna(subset=[group]).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")


def diverse(df: DataFrame, group: str, cluster: str, cap: int, order: list[Column], valid: Column | None = None) -> DataFrame:
    """Up to cap rows of each group: the first of each cluster in order, then the first of the rest.

    A row without a valid cluster (by default null or negative) leads none.
    """
    valid = F.coalesce(F.col(cluster) >= 0, F.lit(False)) if valid is None else valid
    first = F.row_number().over(Window.partitionBy(group, cluster).orderBy(*order))
    out = df.dropna(subset=[group]).withColumn("_follows", F.when(valid & (first == 1), 0).otherwise(1))
    # Only the first cap rows of a group leave a task: Spark limits groups before the exchange.
    pick = F.row_number().over(Window.partitionBy(group).orderBy("_follows", *order))
    return out.withColumn("_pick", pick).where(F.col("_pick") <= cap).drop("_follows", "_pick")


def backfill(rest: DataFrame, needed: int, score: Column, key: str) -> DataFrame:
    """The needed rows of rest with the best score."""
    return first_rows(rest.withColumn("_score", score), needed, F.desc("_score"), F.asc(key)).drop("_score")


def uncovered(rest: DataFrame, chosen: DataFrame, keys: list[str], bonus: float, valid: Column) -> DataFrame:
    """rest with _bonus: bonus where the valid keys occur in no chosen row. It isn't brought up to date as rows are taken."""
    seen = chosen.select(*[F.col(k).alias(f"_c_{k}") for k in keys]).distinct().withColumn("_seen", F.lit(True))
    same = None
    for k in keys:
        one = F.col(k) == F.col(f"_c_{k}")
        same = one if same is None else same & one
    out = rest.join(seen, same, "left")
    return out.withColumn("_bonus", F.when(valid & F.col("_seen").isNull(), bonus).otherwise(0.0)).drop("_seen", *[f"_c_{k}" for k in keys])


def balanced(
    df: DataFrame,
    group: str = "species",
    key: str = "clip_filename",
    score: str = "quality_score",
    salience: str = "acoustic_salience",
    cluster: str = "cluster_id",
    target: int = BALANCE.target,
    clusters: int = BALANCE.clusters,
    bonus: float = BALANCE.bonus,
    mode: str = "compatible",
    dedup_key: str | None = None,
) -> DataFrame:
    """The four phases: cap by target / groups, diversity inside capped groups, backfill by score, trim by salience; then one row of each dedup_key, and a second backfill.

    compatible takes for the backfill the rows of a group *behind* as many as were chosen of it, as the original does,
    which can name a chosen row again; the second backfill makes up for it. strict takes the rows not chosen. key is
    unique; dedup_key is key unless given. With fewer clusters than rows of a group the clusters come from cluster_id;
    groups of at most clusters rows have each row as its own.
    """
    if mode not in ("compatible", "strict"):
        raise ValueError("mode: compatible or strict")
    dedup_key = dedup_key or key
    order = _best(score, salience, key)
    own = df.dropna(subset=[group])
    sizes = count_by(own, group)
    groups = sizes.count()
    if not groups:
        return own
    cap = target // groups
    own = settle(ranked_within(own, group, *order, name="_rank", size="_size"))
    label = F.when(F.col("_size") <= clusters, F.col("_rank") - 1).otherwise(F.col(cluster)).cast("long")
    own = own.withColumn("_cluster", label)
    small = own.where(F.col("_size") <= cap)
    large = diverse(own.where(F.col("_size") > cap), group, "_cluster", cap, order)
    chosen = settle(small.withColumn("_covers", F.lit(None).cast("long")).unionByName(large.withColumn("_covers", F.col("_cluster"))))
    have = chosen.count()
    out = chosen
    if have < target:
        if mode == "compatible":
            counts = chosen.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_have"))
            rest = own.join(counts, own[group] == F.col("_g"), "left").where(F.col("_rank") > F.coalesce("_have", F.lit(0))).drop("_g", "_have")
        else:
            rest = own.join(chosen.select(F.col(key).alias("_k")), own[key] == F.col("_k"), "left_anti")
        valid = F.coalesce(F.col("_cluster") >= 0, F.lit(False))
        named = chosen.select(F.col(group), F.col("_covers").alias("_cluster")).where("_cluster is not null and _cluster >= 0")
        rest = uncovered(rest, named, [group, "_cluster"], bonus, valid)
        points = 10.0 * F.coalesce(F.col(score), F.lit(0)) + F.coalesce(F.col(salience), F.lit(0.0)) + F.col("_bonus")
        out = chosen.unionByName(backfill(rest, target - have, points, key).withColumn("_covers", F.lit(None).cast("long")).drop("_bonus"))
    elif have > target:
        out = first_rows(chosen, target, F.desc_nulls_last(salience), F.asc(key))
    out = settle(keep_first(out, [dedup_key], [F.desc_nulls_last(salience), F.asc(key)]))
    have = out.count()
    if have < target:
        rest = own.join(out.select(F.col(dedup_key).alias("_k")).distinct(), own[dedup_key] == F.col("_k"), "left_anti").withColumn("_covers", F.lit(None).cast("long"))
        points = 10.0 * F.coalesce(F.col(score), F.lit(0)) + F.coalesce(F.col(salience), F.lit(0.0))
        out = out.unionByName(backfill(rest, target - have, points, key))
    return out.drop("_rank", "_size", "_cluster", "_covers")


def balanced_legacy(df: DataFrame, group: str = "species", key: str = "clip_filename", score: str = "quality_score", energy: str = "rms_energy", record: str = "xc_id", target: int = 20_000, bonus: float = BALANCE.bonus) -> DataFrame:
    """The older balancing: diversity by recording, energy instead of salience, and a bonus for recordings not chosen yet. Duplicates that the positional backfill makes are kept, as the original does."""
    order = _best(score, energy, key)
    own = df.dropna(subset=[group])
    groups = count_by(own, group).count()
    if not groups:
        return own
    cap = target // groups
    own = settle(ranked_within(own, group, *order, name="_rank"))
    chosen = settle(diverse(own, group, record, cap, order, valid=F.col(record).isNotNull()))
    have = chosen.count()
    out = chosen
    if have < target:
        counts = chosen.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_have"))
        rest = own.join(counts, own[group] == F.col("_g"), "left").where(F.col("_rank") > F.coalesce("_have", F.lit(0))).drop("_g", "_have")
        rest = uncovered(rest, chosen, [record], bonus, F.lit(True))
        points = 10.0 * F.col(score) + F.col(energy) + F.col("_bonus")
        out = chosen.unionByName(backfill(rest, target - have, points, key).drop("_bonus"))
    elif have > target:
        out = first_rows(chosen, target, F.desc_nulls_last(energy), F.asc(key))
    return out.drop("_rank")


def top_split(df: DataFrame, energy: str, key: str, n: int | None = None, step: int = 1000) -> DataFrame:
    """df with status: keep for the n rows of most energy (by default all full steps), else quarantine."""
    n = df.count() // step * step if n is None else n
    return ranked(df, F.desc_nulls_last(energy), F.asc(key), name="_rank").withColumn("status", F.when(F.col("_rank") <= n, "keep").otherwise("quarantine")).drop("_rank")


def plot_points(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """Ranked sizes of groups before and after, ready to draw."""
    from .hygiene import long_tail

    return long_tail(before, group).withColumn("which", F.lit("before")).unionByName(long_tail(after, group).withColumn("which", F.lit("after")))
