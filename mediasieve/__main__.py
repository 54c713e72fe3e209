"""Command line: python -m mediasieve COMMAND ... Each reads tables, writes one, or with --dry-run only says how many rows it would write."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import balance, corrections, hygiene, metrics, neardup, quota, segments
from .plans import catalogue, pipeline
from .sources import rest, sinks, tables
from .storage import settle


def read(spark: SparkSession, path: str) -> DataFrame:
    return tables.csv_text(spark, path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)


def analyze(spark, a) -> str:
    return sinks.report_text("Metadata", hygiene.statistics(read(spark, a.input), a.species, a.country))


def classify(spark, a) -> DataFrame:
    return pipeline.recordings(read(spark, a.input))


def download(spark, a) -> DataFrame:
    """The files of recordings that are to be fetched, with content, bytes, error and elapsed_s; --limit counts rows of the input."""
    rows = read(spark, a.input)
    rows = pipeline.recordings(rows if a.limit is None else rows.limit(a.limit)).where("status = 'ok'").drop("status", "error")
    return rest.downloaded(rows, "file", "xc_id")


def _waves(spark, a) -> DataFrame:
    return segments.decoded(tables.files(spark, a.input, content=True))


def extract(spark, a) -> DataFrame:
    """Clips of the loudest windows of the audio files below a folder, as wav or FLAC, or why there are none."""
    clips = segments.positive_clips(_waves(spark, a).withColumnRenamed("reason", "decode_reason"), count=a.count)
    clips = clips.withColumns({"reason": F.coalesce("decode_reason", "reason"), "clip_filename": X.clip_name(X.stem("name"), "onset_ms")}).drop("decode_reason")
    return (sinks.with_flac if a.flac else sinks.with_wav)(clips).drop("samples")


def dedup(spark, a) -> str | DataFrame:
    """Duplicate pairs of the audio files below a folder, which of each goes, and the report; --meta names their recordists."""
    waves = settle(_waves(spark, a).withColumn("rec_id", X.record_number("name")).where("samples is not null and rec_id > 0"))
    waves = hygiene.keep_first(waves, ["rec_id"], [F.asc("path")])
    known = tables.keyed(read(spark, a.meta), "id", ["rec"]).select(F.col("id").alias("rec_id"), "rec")
    meta = waves.select("rec_id", X.source_key("name").alias("source"), "seconds").join(known, "rec_id", "left")
    pairs = settle(pipeline.duplicates(waves.select("rec_id", "samples"), meta)[0])
    return pairs if a.output else sinks.report_text("Duplicates", {"totals": neardup.totals(pairs), "pairs": neardup.report(pairs.orderBy(F.desc("sim"), "i", "j"))}, rows=a.rows)


def balanced(spark, a) -> DataFrame:
    df = hygiene.renamed(read(spark, a.input))
    score = F.col("quality_score").try_cast("int") if "quality_score" in df.columns else X.grade_score(X.name_grade(a.key), 5, 3)
    df = df.withColumns({"quality_score": score, "acoustic_salience": F.col("acoustic_salience").try_cast("double"), "cluster_id": F.col("cluster_id").try_cast("long") if "cluster_id" in df.columns else F.lit(-1).cast("long")})
    return balance.balanced(df, key=a.key, target=a.target, mode=a.mode)


def pages(spark, a) -> DataFrame:
    own = read(spark, a.input)
    return quota.pages(quota.hash_sample(own, a.samples, a.key), a.key)


def split(spark, a) -> DataFrame:
    return quota.stratified_split(read(spark, a.input), a.label, a.key)


def evaluate(spark, a) -> DataFrame:
    df = read(spark, a.input).select(F.col(a.label).try_cast("int").alias("label"), F.col(a.score).try_cast("double").alias("score"))
    return metrics.prf1(df).crossJoin(metrics.auc(df)).crossJoin(metrics.average_precision(df))


def correct(spark, a) -> DataFrame:
    rows = tables.csv_checked(spark, a.input, ["clip_filename", "issue_type", "corrected_onset_ms"])
    rows = rows.select("clip_filename", "issue_type", F.coalesce("corrected_onset_ms", F.lit("")).alias("corrected_onset_ms")).withColumn("seq", F.monotonically_increasing_id())
    onsets = read(spark, a.clips).select(X.clip_parts("clip_filename").alias("p")).where("p is not null").select("p.id", "p.onset_ms")
    return corrections.applied(rows, onsets, spark.read.parquet(a.windows), "seq")


def query(spark, a) -> DataFrame:
    return catalogue.QUERIES[a.name](spark, a.input)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="mediasieve", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(f, *options: tuple[str, dict]):
        p = commands.add_parser(f.__name__)
        p.add_argument("input")
        p.add_argument("--output")
        p.add_argument("--dry-run", action="store_true")
        for name, how in options:
            p.add_argument(name, **how)
        p.set_defaults(run=f)

    key = ("--key", {"default": "clip_filename"})
    label = ("--label", {"default": "label"})
    command(analyze, ("--species", {"default": "en"}), ("--country", {"default": "cnt"}))
    command(classify)
    command(download, ("--limit", {"type": int}))
    command(extract, ("--count", {"type": int, "default": 1}), ("--flac", {"action": "store_true"}))
    command(dedup, ("--meta", {"required": True}), ("--rows", {"type": int, "default": 1000}))
    command(balanced, key, ("--target", {"type": int, "default": 25_000}), ("--mode", {"default": "compatible", "choices": ["compatible", "strict"]}))
    command(pages, key, ("--samples", {"type": int, "default": 500}))
    command(split, key, label)
    command(evaluate, label, ("--score", {"default": "score"}))
    command(correct, ("--clips", {"required": True}), ("--windows", {"required": True}))
    command(query, ("--name", {"required": True, "choices": sorted(catalogue.QUERIES)}))
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("mediasieve").getOrCreate()
    out = a.run(spark, a)
    if isinstance(out, str):
        print(out)
    elif a.dry_run or not a.output:
        print(f"{out.count()} rows")
        out.show(20, truncate=False)
    elif a.output.endswith(".csv"):
        sinks.write_csv(out, a.output)
    else:
        out.write.mode("overwrite").parquet(a.output)


if __name__ == "__main__":
    main()
