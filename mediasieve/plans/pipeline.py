"""The two curation branches as lazy compositions; callers choose what to write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AUDIO, BALANCE
from ..functions import text as X
from ..operators import balance, clustering, hygiene, neardup, segments
from ..sources import tables


def recordings(metadata: DataFrame) -> DataFrame:
    """Metadata: rows of the group, one a number, no unknown species, with status, canonical id, grade and output name."""
    own = hygiene.excluded(hygiene.drop_heavy(metadata), "en")
    own = own.withColumn("_id", X.canonical_id("id"))
    own = hygiene.keep_first(own, ["_id"], [F.asc_nulls_last(c) for c in own.columns if c != "_id"]).drop("_id")
    s = hygiene.status_of("id", "file", "length")
    own = own.withColumn("_s", s).withColumns({"status": F.col("_s.status"), "error": F.col("_s.error"), "xc_id": X.canonical_id("id"), "grade": X.grade_of("q")}).drop("_s")
    return own.withColumn("out_path", F.concat(X.sanitize_name("en"), F.lit("/"), X.output_name("id", "q")))


def duplicates(waves: DataFrame, meta: DataFrame, key: str = "rec_id") -> tuple[DataFrame, DataFrame]:
    """(pairs, removed): verified pairs of waves (key, samples, source, seconds, rec) with the keep rule and its outcome."""
    emb = neardup.settle(neardup.embeddings(waves, key))
    near = neardup.neighbours(emb.where("descriptor is not null"), key, "descriptor")
    pairs = neardup.candidates(near, meta, key, "source", "seconds")
    pairs = neardup.verified(pairs, emb, key, "frames", 128).where("kind is not null")
    rec = meta.select(F.col(key), "rec")
    pairs = pairs.join(rec.toDF("i", "rec_i"), "i", "left").join(rec.toDF("j", "rec_j"), "j", "left")
    pairs = neardup.with_keep_rule(pairs, "i", "j", sim="sim")
    done = neardup.resolved(pairs.withColumn("_rank", F.when(F.col("kind") == "perfect", 0).otherwise(1)).withColumn("_neg", -F.col("sim")), ["_rank", "_neg", "i", "j"], "i", "j").drop("_rank", "_neg")
    return done, done.where("taken").select(F.col("removed").alias(key)).distinct()


def clips(waves: DataFrame, audio=AUDIO) -> DataFrame:
    """One clip of each wave with onset, energy, salience and embedding."""
    return segments.features(segments.positive_clips(waves, audio=audio).where("status = 'ok'"), rate=audio.rate)


def balanced_set(clips: DataFrame, group: str = "species", key: str = "clip_filename", target: int = BALANCE.target, k: int = BALANCE.clusters) -> DataFrame:
    """Clips with embedding and salience, clustered in their groups and balanced."""
    order = [F.desc_nulls_last("quality_score"), F.desc_nulls_last("acoustic_salience"), F.asc(key)]
    return balance.balanced(clustering.cluster_within(clips, group, key, "embedding", order, k), group, key, target=target, clusters=k)


def negative_set(manifest: DataFrame, kind: str, waves: DataFrame, prefix: str, pad: bool = False, width: int = 5, audio=AUDIO) -> DataFrame:
    """Negatives of one corpus: filtered manifest, its waves (key, samples), the loudest window of each, and the output name."""
    own = tables.negatives(manifest, kind).join(waves, "key")
    out = segments.negative_clips(own, pad=pad, audio=audio)
    return out.withColumn("name", F.when(F.col("status") == "ok", X.negative_name(prefix, "key", "onset_ms", width, F.col("is_short") if pad else None)))


def run_matrix(spark, models: list[str], seeds: list[int]) -> DataFrame:
    """Every model with every seed."""
    return spark.createDataFrame([(m,) for m in models], "model string").crossJoin(spark.createDataFrame([(s,) for s in seeds], "seed int"))


def cached_features(files: DataFrame, cache: DataFrame | None, compute) -> tuple[DataFrame, DataFrame]:
    """(features of all files, the new ones among them): rows of the cache by key where they are, else compute(files without). Append the new ones to the cache."""
    keyed = files.withColumn("key", X.cache_key("path"))
    missing = keyed if cache is None else hygiene.pending(keyed, cache, "key")
    new = compute(missing)
    if cache is None:
        return new, new
    known = cache.join(keyed.select("key").distinct(), "key", "left_semi")
    return known.unionByName(new, allowMissingColumns=True), new
