"""Metadata hygiene: deduplication, exclusion, enrichment, status of rows, and statistics over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import GROUP_FIELDS, HEAVY_COLUMNS, OUTPUT_COLUMNS, UNKNOWN_SPECIES
from ..functions import text as X
from ..storage import ranked


def drop_heavy(df: DataFrame) -> DataFrame:
    return df.drop(*HEAVY_COLUMNS)


def with_provenance(df: DataFrame, value: str, name: str = "fetch_country") -> DataFrame:
    return df.withColumn(name, F.lit(value))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def narrowed(df: DataFrame, columns=OUTPUT_COLUMNS) -> DataFrame:
    """The output columns; missing ones are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def renamed(df: DataFrame, old: str = "en", new: str = "species") -> DataFrame:
    return df if new in df.columns else df.withColumnRenamed(old, new)


def require(df: DataFrame, columns) -> DataFrame:
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order. Null keys are one key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in a total order given ascending."""
    from_end = [F.desc_nulls_first(c) if isinstance(c, str) else c.desc_nulls_first() for c in order]
    return keep_first(df, key, from_end)


def excluded(df: DataFrame, column: str, values=UNKNOWN_SPECIES) -> DataFrame:
    """Without the listed values; nulls stay."""
    return df.where(X.not_in(column, values))


def non_blank(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(X.cleaned(c).isNotNull())
    return df


def of_group(df: DataFrame, fields=GROUP_FIELDS) -> DataFrame:
    """Rows of which one of the fields there are names the group looked for."""
    there = [f for f in fields if f in df.columns]
    return df.where(X.mentions(there)) if there else df.where(F.lit(False))


def enrich(clips: DataFrame, meta: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """clips with the columns of meta named in defaults; where a key is unknown the default. meta has a row a key."""
    named = meta.select(F.col(key).alias("_key"), F.lit(True).alias("_known"), *[F.col(c).alias(f"_m_{c}") for c in defaults])
    joined = clips.join(named, clips[key] == F.col("_key"), "left")
    for c, default in defaults.items():
        joined = joined.withColumn(c, F.when(F.col("_known"), F.col(f"_m_{c}")).otherwise(default))
    return joined.drop("_key", "_known", *[f"_m_{c}" for c in defaults])


def match_grade(files: DataFrame, meta: DataFrame, key: str, file_grade: str, meta_grade: str) -> DataFrame:
    """files whose key is in meta with the same grade; that grade under its own name."""
    named = meta.select(F.col(key).alias("_key"), F.col(meta_grade).alias("_grade"))
    return files.join(named, (files[key] == F.col("_key")) & X.grades_match(files[file_grade], F.col("_grade"))).drop("_key").withColumnRenamed("_grade", f"meta_{meta_grade}")


def remove_keys(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key isn't in keys, and those whose key is."""
    listed = keys.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    same = df[key] == F.col("_key")
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What isn't among the outputs yet."""
    return remove_keys(df, done, key)[0]


def status_of(id_col: str, url: str, length: str, actual: Column | None = None, exists: Column | None = None, size: Column | None = None, converted: Column | None = None, dry: bool = False, min_s: float = 3.0, min_actual_s: float = 3.01, min_bytes: int = 1024) -> Column:
    """Struct (status, error) of a row on its way from metadata to an output file, the first reason that holds.

    skip: missing id, no URL, declared too short; exists; dry; fail: too few bytes; skip: too short in fact (an unknown
    duration passes); conversion_failed; ok.
    """

    def outcome(status: str, error: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(error).alias("error"))

    out = F.when(X.cleaned(id_col).isNull(), outcome("skip", "missing id")).when(X.null_like(url), outcome("skip", "no_url")).when(X.seconds_loose(length) < min_s, outcome("skip", "too_short"))
    if exists is not None:
        out = out.when(exists, outcome("exists", ""))
    if dry:
        return out.otherwise(outcome("dry", ""))
    if size is not None:
        out = out.when(size < min_bytes, outcome("fail", "too_small"))
    if actual is not None:
        out = out.when(F.coalesce(actual < min_actual_s, F.lit(False)), outcome("skip", "too_short_actual"))
    if converted is not None:
        out = out.when(~converted, outcome("fail", "conversion_failed"))
    return out.otherwise(outcome("ok", ""))


def count_by(df: DataFrame, *key: str) -> DataFrame:
    """Rows of each key that isn't null."""
    return df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def top_groups(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return count_by(df, key).orderBy(F.desc("n"), F.asc(key)).limit(n)


def bottom_groups(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return count_by(df, key).orderBy(F.asc("n"), F.asc(key)).limit(n)


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.countDistinct(key).alias("n"))


def exclusive_groups(df: DataFrame, item: str, group: str) -> DataFrame:
    """For each group the items that occur in it alone: (group, n_items, n_exclusive, pct of all distinct items of df)."""
    own = df.dropna(subset=[item, group])
    where = own.groupBy(item).agg(F.count_distinct(group).alias("g"), F.min(group).alias("only"))
    alone = where.where("g = 1").groupBy(F.col("only").alias(group)).agg(F.count(F.lit(1)).alias("n_exclusive"))
    sizes = own.groupBy(group).agg(F.count_distinct(item).alias("n_items"))
    total = where.agg(F.count(F.lit(1)).alias("_all"))
    out = sizes.join(alone, group, "left").crossJoin(F.broadcast(total))  # one row is broadcast
    n = F.coalesce("n_exclusive", F.lit(0).cast("long"))
    return out.select(group, "n_items", n.alias("n_exclusive"), (100.0 * n / F.col("_all")).alias("pct"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact median and population deviation of a column; nulls without any values. The median comes from ranks, so no task holds all values."""
    own = df.select(F.col(column).cast("double").alias("_x")).where("_x is not null")
    places = ranked(own, "_x", name="_at")
    n = places.agg(F.max("_at").alias("_n"))
    middle = places.crossJoin(F.broadcast(n)).where("_at = (_n + 1) div 2 or _at = _n div 2 + 1").agg(F.avg("_x").alias("median"))  # one row is broadcast
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")).crossJoin(F.broadcast(middle)).select("mean", "median", "std")


def group_sizes(df: DataFrame, *key: str) -> DataFrame:
    """Groups, and mean, least and most rows of a group."""
    return count_by(df, *key).agg(F.count(F.lit(1)).alias("groups"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


def gini(df: DataFrame, *key: str) -> DataFrame:
    """Gini coefficient of the sizes of groups; 0 without groups.

    Computed over distinct sizes, of which there are few however many the groups: groups of one size take a run of places.
    """
    sizes = count_by(df, *key).groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = F.col("m") * before + F.col("m") * (F.col("m") + 1) / 2
    s = sizes.withColumn("places", places).agg(F.sum(F.col("places") * F.col("n")).alias("a"), F.sum(F.col("m") * F.col("n")).alias("c"), F.sum("m").alias("g"))
    value = 2.0 * F.col("a") / (F.col("g") * F.col("c")) - (F.col("g") + 1.0) / F.col("g")
    return s.select(F.coalesce(value, F.lit(0.0)).alias("gini"))


def gini_reduction(before: DataFrame, after: DataFrame, *key: str) -> DataFrame:
    """Gini before and after, and the reduction in percent."""
    a, b = gini(before, *key).withColumnRenamed("gini", "gini_before"), gini(after, *key).withColumnRenamed("gini", "gini_after")
    return a.crossJoin(b).withColumn("reduction_pct", F.when(F.col("gini_before") > 0, 100.0 * (F.col("gini_before") - F.col("gini_after")) / F.col("gini_before")).otherwise(0.0))


def long_tail(df: DataFrame, *key: str) -> DataFrame:
    """Groups with their size and rank, the largest first."""
    return ranked(count_by(df, *key), F.desc("n"), *[F.asc(k) for k in key])


def shares(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Percentage of rows whose column is one of values."""
    return df.agg((100.0 * F.count_if(F.col(column).isin(*values)) / F.count(F.lit(1))).alias("pct"))


def grade_pivot(df: DataFrame, group: str, grade: str, letters=("A", "B", "C", "D", "U")) -> DataFrame:
    """Rows of each group and grade, a column a grade, 0 where there are none."""
    return df.dropna(subset=[group]).groupBy(group).agg(*[F.count_if(F.col(grade) == g).alias(g) for g in letters])


def groups_with_grade(df: DataFrame, group: str, grade: str, letters=("A", "B", "C", "D", "U")) -> DataFrame:
    return grade_pivot(df, group, grade, letters).agg(*[F.count_if(F.col(g) > 0).alias(g) for g in letters])


def per_record(df: DataFrame, record: str) -> DataFrame:
    """Mean rows for each distinct record."""
    return df.agg((F.count(F.lit(1)) / F.count_distinct(record)).alias("ratio"))


def reason_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def statistics(df: DataFrame, species: str = "en", country: str = "cnt", n: int = 10) -> dict[str, DataFrame]:
    """The metadata report: rows by country, species by country, most and least common species, exclusive species."""
    own = excluded(non_blank(df, species, country), species)
    return {
        "by_country": count_by(own, country).orderBy(F.desc("n"), country),
        "distinct_species": distinct_count(own, species),
        "top": top_groups(own, species, n),
        "bottom": bottom_groups(own, species, n),
        "exclusive": exclusive_groups(own, species, country),
    }
