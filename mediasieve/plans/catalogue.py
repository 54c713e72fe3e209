"""Queries of the library over the supplied tables, each with the DuckDB SQL that must give the same rows.

Clips are documents with their labels: species is source and language, grade comes from quality, salience from the
length; the waveform of a recording is the values of a user's events in time; descriptors are embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import dsp
from ..functions import text as X
from ..operators import balance, clustering, corrections, hygiene, metrics, neardup, quota, segments
from ..sources import sinks, tables
from ..storage import first_rows, shared_dir
from ..streaming import ingest
from .pipeline import run_matrix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Window, hop and separation of the event waveforms, and the least energy of a window.
WINDOW, HOP, APART, LOUD = 10, 2, 5, 60.0

CLIPS = """
clips AS (
  SELECT d.doc_id, d.source || '|' || d.lang AS species, d.lang AS country, d.source AS recordist,
    CASE l.quality WHEN 1 THEN 'A' WHEN 0 THEN 'C' ELSE 'U' END AS grade,
    CASE l.quality WHEN 1 THEN 5 ELSE 3 END AS score, CAST(d.n_chars % 997 AS DOUBLE) / 997 AS salience,
    d.n_chars % 5 AS cluster_id, d.n_chars % 50 AS record, d.n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""
WINDOWS = f"""
frames AS (
  SELECT user_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS sz,
    sum(value * value) OVER (w ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS e, count(*) OVER (w ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), windows AS (
  SELECT user_id, rn - 1 AS start, round(sqrt(e / n), 6) AS rms, n FROM frames WHERE (n = {WINDOW} AND (rn - 1) % {HOP} = 0) OR (sz < {WINDOW} AND rn = 1)
)"""
SCORED = "scored AS (SELECT doc_id, quality AS label, CAST((doc_id * 37) % 101 AS DOUBLE) / 100 AS score FROM labels)"
PAIRS = """
firsts AS (SELECT md5(text) AS digest, min(doc_id) AS i FROM documents GROUP BY 1 HAVING count(*) > 1),
pairs AS (
  SELECT f.i, d.doc_id AS j, a.source AS rec_i, d.source AS rec_j FROM firsts f JOIN documents d ON md5(d.text) = f.digest AND d.doc_id > f.i JOIN documents a ON a.doc_id = f.i
)"""


def query(sql: str | None = None, name: str | None = None):
    """Registers a function as a query, and sql as what it must equal."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def clips(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.concat("source", F.lit("|"), "lang").alias("species"),
        F.col("lang").alias("country"),
        F.col("source").alias("recordist"),
        F.when(F.col("quality") == 1, "A").when(F.col("quality") == 0, "C").otherwise("U").alias("grade"),
        F.when(F.col("quality") == 1, 5).otherwise(3).alias("score"),
        ((F.col("n_chars") % 997).cast("double") / 997).alias("salience"),
        (F.col("n_chars") % 5).alias("cluster_id"),
        (F.col("n_chars") % 50).alias("record"),
        "n_chars",
    )


def windows(spark: SparkSession, d: str) -> DataFrame:
    return segments.row_windows(table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", WINDOW, HOP).withColumn("rms", F.round("rms", 6))


def scored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"), (((F.col("doc_id") * 37) % 101).cast("double") / 100).alias("score"))


def best() -> list:
    return [F.desc("score"), F.desc("salience"), F.asc("doc_id")]


# Counts and statistics of groups


@query("SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def count_by_key_desc(spark, d):
    return hygiene.count_by(table(spark, d, "documents"), "source").orderBy(F.desc("n"), "source")


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def count_by_key_sorted(spark, d):
    return hygiene.count_by(table(spark, d, "documents"), "lang").orderBy("lang")


@query(f"WITH {CLIPS} SELECT count(DISTINCT species) AS n FROM clips")
def distinct_groups(spark, d):
    return hygiene.distinct_count(clips(spark, d), "species")


@query("""
WITH x AS (SELECT md5(text) AS item, lang FROM documents), w AS (SELECT item, count(DISTINCT lang) AS g, min(lang) AS alone FROM x GROUP BY item)
SELECT lang, count(DISTINCT item) AS n_items, coalesce(max(e.n), 0) AS n_exclusive, round(100.0 * coalesce(max(e.n), 0) / (SELECT count(*) FROM w), 6) AS pct
FROM x LEFT JOIN (SELECT alone, count(*) AS n FROM w WHERE g = 1 GROUP BY alone) e ON e.alone = lang GROUP BY lang""")
def exclusive_groups(spark, d):
    x = table(spark, d, "documents").select(F.md5("text").alias("item"), "lang")
    return hygiene.exclusive_groups(x, "item", "lang").withColumn("pct", F.round("pct", 6))


@query(f"WITH {CLIPS} SELECT species, count(*) AS n FROM clips GROUP BY 1 ORDER BY n DESC, species LIMIT 10")
def top_groups(spark, d):
    return hygiene.top_groups(clips(spark, d), "species")


@query(f"WITH {CLIPS} SELECT species, count(*) AS n FROM clips GROUP BY 1 ORDER BY n, species LIMIT 10")
def bottom_groups(spark, d):
    return hygiene.bottom_groups(clips(spark, d), "species")


@query(f"WITH {CLIPS}, g AS (SELECT count(*) AS n FROM clips GROUP BY species) SELECT count(*) AS groups, round(avg(n), 6) AS mean, min(n) AS least, max(n) AS most FROM g")
def group_sizes(spark, d):
    return hygiene.group_sizes(clips(spark, d), "species").withColumn("mean", F.round("mean", 6))


@query(f"WITH {CLIPS} SELECT round(avg(salience), 6) AS mean, round(median(salience), 6) AS median, round(stddev_pop(salience), 6) AS std FROM clips")
def describe_salience(spark, d):
    return hygiene.describe(clips(spark, d), "salience").select(*[F.round(c, 6).alias(c) for c in ("mean", "median", "std")])


@query(f"WITH {CLIPS} SELECT round(count(*) / count(DISTINCT record), 6) AS ratio FROM clips")
def samples_per_recording(spark, d):
    return hygiene.per_record(clips(spark, d), "record").withColumn("ratio", F.round("ratio", 6))


def _gini(source: str) -> str:
    return f"g AS (SELECT count(*) AS c FROM {source} GROUP BY species), r AS (SELECT c, row_number() OVER (ORDER BY c) AS i, count(*) OVER () AS n FROM g) SELECT round(coalesce(2.0 * sum(CAST(i * c AS DOUBLE)) / (max(n) * sum(c)) - (max(n) + 1.0) / max(n), 0), 6)"


@query(f"WITH {CLIPS}, {_gini('clips')} AS gini FROM r")
def gini_before(spark, d):
    return hygiene.gini(clips(spark, d), "species").withColumn("gini", F.round("gini", 6))


CAPPED = f"{CLIPS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY score DESC, salience DESC, doc_id) AS rk FROM clips), capped AS (SELECT * FROM ranked WHERE rk <= 6)"


@query(f"WITH {CAPPED}, {_gini('capped')} AS gini FROM r")
def gini_after(spark, d):
    return hygiene.gini(balance.capped(clips(spark, d), "species", 6, best()), "species").withColumn("gini", F.round("gini", 6))


@query(f"WITH {CAPPED}, b AS (WITH {_gini('clips')} AS x FROM r), a AS (WITH {_gini('capped')} AS x FROM r) SELECT b.x AS gini_before, a.x AS gini_after, round(CASE WHEN b.x > 0 THEN 100.0 * (b.x - a.x) / b.x ELSE 0 END, 2) AS reduction_pct FROM a, b")
def gini_reduction(spark, d):
    own = clips(spark, d)
    out = hygiene.gini_reduction(own, balance.capped(own, "species", 6, best()), "species")
    return out.select(F.round("gini_before", 6).alias("gini_before"), F.round("gini_after", 6).alias("gini_after"), F.round("reduction_pct", 2).alias("reduction_pct"))


@query(f"WITH {CLIPS} SELECT species, n, row_number() OVER (ORDER BY n DESC, species) AS rank FROM (SELECT species, count(*) AS n FROM clips GROUP BY species)")
def long_tail_rank(spark, d):
    return hygiene.long_tail(clips(spark, d), "species")


@query(f"WITH {CLIPS} SELECT species, {', '.join(f'''count(*) FILTER (grade = '{g}') AS "{g}"''' for g in 'ABCDU')} FROM clips GROUP BY species")
def grade_pivot(spark, d):
    return hygiene.grade_pivot(clips(spark, d), "species", "grade")


@query(f"WITH {CLIPS} SELECT {', '.join(f'''count(DISTINCT species) FILTER (grade = '{g}') AS "{g}"''' for g in 'ABCDU')} FROM clips")
def groups_with_grade(spark, d):
    return hygiene.groups_with_grade(clips(spark, d), "species", "grade")


@query(f"WITH {CLIPS} SELECT round(100.0 * count(*) FILTER (grade IN ('A', 'B')) / count(*), 6) AS pct FROM clips")
def ab_share(spark, d):
    return hygiene.shares(clips(spark, d), "grade", ["A", "B"]).withColumn("pct", F.round("pct", 6))


# Hygiene of rows


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.quality NOT IN (0)")
def exclude_list_null_safe(spark, d):
    both = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return hygiene.excluded(both, "quality", [0]).na.fill(-1)


@query("SELECT page_id FROM pages WHERE regexp_matches(lower(trim(url)), 'spam|blog') OR regexp_matches(lower(trim(html)), 'spam|blog')")
def keyword_any_field(spark, d):
    return table(spark, d, "pages").where(X.mentions(["url", "html"], ["spam", "blog"])).select("page_id")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedup_keep_first(spark, d):
    own = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("k"))
    return hygiene.keep_first(own, ["k"], [F.asc("doc_id")]).select("doc_id", "source")


META = """
meta AS (
  SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN ' ' ELSE CAST(doc_id AS VARCHAR) END AS id,
    CASE WHEN doc_id % 13 = 0 THEN 'NaN' WHEN doc_id % 19 = 0 THEN NULL ELSE 'https://example.org/' || doc_id || '.mp3' END AS file,
    CASE doc_id % 7 WHEN 0 THEN '0:02' WHEN 1 THEN '1:05' WHEN 2 THEN '1:00:00' WHEN 3 THEN CAST(n_chars % 90 AS VARCHAR) || '.5' WHEN 4 THEN 'abc' WHEN 5 THEN '' ELSE '0:' || lpad(CAST(n_chars % 60 AS VARCHAR), 2, '0') END AS length,
    n_chars
  FROM documents
)"""


def meta(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    length = F.when(n % 7 == 0, "0:02").when(n % 7 == 1, "1:05").when(n % 7 == 2, "1:00:00").when(n % 7 == 3, F.concat((F.col("n_chars") % 90).cast("string"), F.lit(".5"))).when(n % 7 == 4, "abc").when(n % 7 == 5, "")
    length = length.otherwise(F.concat(F.lit("0:"), F.lpad((F.col("n_chars") % 60).cast("string"), 2, "0")))
    file = F.when(n % 13 == 0, "NaN").when(n % 19 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("https://example.org/"), n.cast("string"), F.lit(".mp3")))
    return table(spark, d, "documents").select("doc_id", F.when(n % 17 == 0, " ").otherwise(n.cast("string")).alias("id"), file.alias("file"), length.alias("length"), "n_chars")


STATUS = """
secs AS (
  SELECT *, coalesce(CASE len(string_split(length, ':')) WHEN 1 THEN try_cast(length AS DOUBLE) WHEN 2 THEN try_cast(string_split(length, ':')[1] AS INTEGER) * 60 + try_cast(string_split(length, ':')[2] AS INTEGER) END, 0) AS s FROM meta
), status AS (
  SELECT doc_id, CASE WHEN trim(id) = '' THEN 'skip' WHEN file IS NULL OR upper(file) IN ('NULL', 'NONE', 'NAN', 'NA') THEN 'skip' WHEN s < 3 THEN 'skip' WHEN n_chars < 1024 THEN 'fail' ELSE 'ok' END AS status,
    CASE WHEN trim(id) = '' THEN 'missing id' WHEN file IS NULL OR upper(file) IN ('NULL', 'NONE', 'NAN', 'NA') THEN 'no_url' WHEN s < 3 THEN 'too_short' WHEN n_chars < 1024 THEN 'too_small' ELSE '' END AS error
  FROM secs
)"""


@query(f"WITH {META}, {STATUS} SELECT * FROM status")
def classify_status(spark, d):
    s = hygiene.status_of("id", "file", "length", size=F.col("n_chars"))
    return meta(spark, d).select("doc_id", s.alias("s")).select("doc_id", "s.status", "s.error")


@query(f"WITH {META}, {STATUS} SELECT status, error, count(*) AS n FROM status GROUP BY ALL")
def reason_counts(spark, d):
    return hygiene.reason_counts(classify_status(spark, d), "status", "error")


@query(f"""WITH {META}, {STATUS}, p AS (SELECT doc_id, s, string_split(length, ':') AS p FROM secs)
SELECT doc_id, round(s, 6) AS loose, CAST(CASE len(p) WHEN 2 THEN try_cast(p[1] AS INTEGER) * 60 + try_cast(p[2] AS INTEGER) WHEN 3 THEN try_cast(p[1] AS INTEGER) * 3600 + try_cast(p[2] AS INTEGER) * 60 + try_cast(p[3] AS INTEGER) END AS DOUBLE) AS clock FROM p""")
def parse_duration_two_dialects(spark, d):
    return meta(spark, d).select("doc_id", F.round(X.seconds_loose("length"), 6).alias("loose"), X.seconds_clock("length").alias("clock"))


@query(r"""SELECT p_partkey, regexp_replace(regexp_replace(trim(p_name || ' / ' || p_type), '[/\\:*?"<>|]', '_', 'g'), '\s+', '_', 'g') AS folder FROM part""")
def sanitize_name(spark, d):
    return table(spark, d, "part").select("p_partkey", X.sanitize_name(F.concat("p_name", F.lit(" / "), "p_type")).alias("folder"))


@query(r"""WITH b AS (SELECT page_id, regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1) AS b FROM pages)
SELECT page_id, CASE WHEN regexp_extract(b, '^\.*[^.].*(\.[^.]*)$', 1) <> '' THEN regexp_extract(b, '^\.*[^.].*(\.[^.]*)$', 1) ELSE '.mp3' END AS ext FROM b""")
def url_extension(spark, d):
    return table(spark, d, "pages").select("page_id", X.url_extension("url").alias("ext"))


@query("""WITH x AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey || '.0' WHEN 1 THEN 'XC' || c_custkey WHEN 2 THEN ' ' || c_custkey || ' ' ELSE 'none' END AS raw FROM customer)
SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN 'none' ELSE CAST(c_custkey AS VARCHAR) END AS id FROM x""")
def canonical_id(spark, d):
    k = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(k, F.lit(".0"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("XC"), k)).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit(" "), k, F.lit(" "))).otherwise("none")
    return table(spark, d, "customer").select("c_custkey", X.canonical_id(raw).alias("id"))


NAMES = f"{CLIPS}, names AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'noise_' || doc_id || '.wav' ELSE CASE WHEN doc_id % 2 = 0 THEN 'xc' ELSE 'XC' END || doc_id || '_' || grade || '_' || (n_chars * 100) || '.wav' END AS name FROM clips)"


def names(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    full = F.concat(F.when(n % 2 == 0, "xc").otherwise("XC"), n.cast("string"), F.lit("_"), "grade", F.lit("_"), (F.col("n_chars") * 100).cast("string"), F.lit(".wav"))
    return clips(spark, d).select("doc_id", F.when(n % 5 == 0, F.concat(F.lit("noise_"), n.cast("string"), F.lit(".wav"))).otherwise(full).alias("name"))


@query(rf"""WITH {NAMES} SELECT doc_id, coalesce(try_cast(regexp_extract(lower(name), '^xc(\d+)(_|\.)', 1) AS BIGINT), 0) AS number,
CASE WHEN doc_id % 5 = 0 THEN 'noise_' || doc_id ELSE regexp_extract(name, '^([^_]*_[^_]*)_', 1) END AS source, nullif(regexp_extract(name, '(?i)xc(\d+)', 1), '') AS id,
CASE WHEN upper(regexp_extract(name, '(?i)xc\d+_([A-DU])', 1)) = '' THEN 'U' ELSE upper(regexp_extract(name, '(?i)xc\d+_([A-DU])', 1)) END AS grade,
CASE WHEN regexp_matches(name, '^xc(\d+)_([A-Ea-e])_(\d+)\.wav$') THEN CAST(regexp_extract(name, '_(\d+)\.wav$', 1) AS BIGINT) ELSE -1 END AS onset_ms FROM names""")
def parse_filename(spark, d):
    return names(spark, d).select("doc_id", X.record_number("name").alias("number"), X.source_key("name").alias("source"), X.record_id("name").alias("id"), X.name_grade("name").alias("grade"), F.coalesce(X.clip_parts("name")["onset_ms"], F.lit(-1).cast("long")).alias("onset_ms"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN -1 ELSE l.quality END AS quality, CASE WHEN l.doc_id IS NULL THEN 0 ELSE l.toxic END AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def enrich_with_default(spark, d):
    return hygiene.enrich(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", {"quality": F.lit(-1), "toxic": F.lit(0)})


@query("SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE CASE WHEN d.n_chars % 3 = 0 THEN 'A' ELSE 'U' END = CASE l.quality WHEN 1 THEN 'A' ELSE 'U' END")
def match_grade_residual(spark, d):
    files = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") % 3 == 0, "a").otherwise("N").alias("g"))
    rated = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "A").otherwise("no score").alias("q"))
    return hygiene.match_grade(files, rated, "doc_id", "g", "q").select("doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def remove_keys(spark, d):
    return hygiene.remove_keys(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").where("toxic = 1"), "doc_id")[0]


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def removed_tracked(spark, d):
    return hygiene.remove_keys(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").where("toxic = 1"), "doc_id")[1]


@query(f"WITH {CLIPS} SELECT doc_id, CASE grade WHEN 'A' THEN 4 WHEN 'C' THEN 2 ELSE 0 END AS older, CASE grade WHEN 'A' THEN 5 ELSE 3 END AS newer FROM clips")
def quality_score_both_maps(spark, d):
    return clips(spark, d).select("doc_id", X.grade_score("grade").alias("older"), X.grade_score("grade", 5, 3).alias("newer"))


@query("SELECT o_orderkey, CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || (s % 3600) // 60 || 'm ' || s % 60 || 's' WHEN s >= 60 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s || 's' END AS spoken FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 50) AS BIGINT) AS s FROM orders)")
def spoken_time(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.spoken_time(F.col("o_totalprice") / 50).alias("spoken"))


@query("SELECT user_id, 'neg-' || user_id || '-' || CASE WHEN length(CAST(n * 37 AS VARCHAR)) >= 5 THEN CAST(n * 37 AS VARCHAR) ELSE lpad(CAST(n * 37 AS VARCHAR), 5, '0') END || CASE WHEN n % 2 = 0 THEN '_padded.wav' ELSE '.wav' END AS name FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)")
def negative_names(spark, d):
    n = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("user_id", X.negative_name("neg", F.col("user_id").cast("string"), F.col("n") * 37, 5, F.col("n") % 2 == 0).alias("name"))


# Balancing


@query(f"WITH {CAPPED} SELECT doc_id, species FROM capped")
def cap_per_group(spark, d):
    return balance.capped(clips(spark, d), "species", 6, best()).select("doc_id", "species")


def _diverse(key: str, valid: str) -> str:
    return f"""WITH {CLIPS}, r AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY score DESC, salience DESC, doc_id) AS rk,
  CASE WHEN {valid} AND row_number() OVER (PARTITION BY species, {key} ORDER BY score DESC, salience DESC, doc_id) = 1 THEN 0 ELSE 1 END AS follows FROM clips)
SELECT doc_id, species FROM (SELECT *, row_number() OVER (PARTITION BY species ORDER BY follows, rk) AS pick FROM r) WHERE pick <= 4"""


@query(_diverse("cluster_id", "cluster_id >= 0"))
def one_per_cluster_then_fill(spark, d):
    return balance.diverse(clips(spark, d), "species", "cluster_id", 4, best()).select("doc_id", "species")


@query(_diverse("record", "record IS NOT NULL"))
def one_per_key_then_fill(spark, d):
    return balance.diverse(clips(spark, d), "species", "record", 4, best(), valid=F.col("record").isNotNull()).select("doc_id", "species")


@query(f"WITH {CAPPED} SELECT doc_id, species FROM ranked WHERE rk > 6 ORDER BY CAST(10 AS DOUBLE) * score + salience DESC, doc_id LIMIT (SELECT count(*) // 10 FROM clips)")
def backfill_topk(spark, d):
    own = clips(spark, d)
    rest = own.join(balance.capped(own, "species", 6, best()).select(F.col("doc_id").alias("k")), F.col("doc_id") == F.col("k"), "left_anti")
    return balance.backfill(rest, own.count() // 10, 10.0 * F.col("score") + F.col("salience"), "doc_id").select("doc_id", "species")


@query(f"""WITH {CAPPED}, seen AS (SELECT DISTINCT species, cluster_id FROM capped), x AS (
  SELECT k.doc_id, k.species, CAST(10 AS DOUBLE) * score + salience + CASE WHEN k.cluster_id >= 0 AND s.species IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END AS points
  FROM ranked k LEFT JOIN seen s ON k.species = s.species AND k.cluster_id = s.cluster_id WHERE rk > 6)
SELECT doc_id, species FROM x ORDER BY points DESC, doc_id LIMIT (SELECT count(*) // 10 FROM clips)""")
def backfill_with_bonus(spark, d):
    own = clips(spark, d)
    chosen = balance.capped(own, "species", 6, best())
    rest = own.join(chosen.select(F.col("doc_id").alias("k")), F.col("doc_id") == F.col("k"), "left_anti")
    rest = balance.uncovered(rest, chosen, ["species", "cluster_id"], 100.0, F.col("cluster_id") >= 0)
    return balance.backfill(rest, own.count() // 10, 10.0 * F.col("score") + F.col("salience") + F.col("_bonus"), "doc_id").select("doc_id", "species")


def _balanced(rest: str) -> str:
    return f"""WITH {CLIPS}, p AS (SELECT count(*) // 2 AS target, (count(*) // 2) // count(DISTINCT species) AS cap FROM clips),
o AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY score DESC, salience DESC, doc_id) AS rk, count(*) OVER (PARTITION BY species) AS sz FROM clips),
l AS (SELECT *, CASE WHEN sz <= 5 THEN rk - 1 ELSE cluster_id END AS cl FROM o),
dv AS (SELECT *, CASE WHEN cl >= 0 AND row_number() OVER (PARTITION BY species, cl ORDER BY rk) = 1 THEN 0 ELSE 1 END AS follows FROM l WHERE sz > (SELECT cap FROM p)),
dp AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY follows, rk) AS pick FROM dv),
chosen AS (SELECT doc_id, species, NULL AS covers FROM l WHERE sz <= (SELECT cap FROM p) UNION ALL SELECT doc_id, species, cl FROM dp WHERE pick <= (SELECT cap FROM p)),
had AS (SELECT species, count(*) AS n FROM chosen GROUP BY species), seen AS (SELECT DISTINCT species, covers FROM chosen WHERE covers >= 0),
rest AS (SELECT l.* FROM l LEFT JOIN had ON l.species = had.species WHERE {rest}),
bf AS (SELECT r.doc_id, r.species FROM rest r LEFT JOIN seen s ON r.species = s.species AND r.cl = s.covers
  ORDER BY CAST(10 AS DOUBLE) * score + salience + CASE WHEN r.cl >= 0 AND s.species IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END DESC, r.doc_id LIMIT (SELECT greatest(0, target - (SELECT count(*) FROM chosen)) FROM p)),
once AS (SELECT DISTINCT doc_id, species FROM (SELECT doc_id, species FROM chosen UNION ALL SELECT * FROM bf)),
more AS (SELECT doc_id, species FROM l WHERE doc_id NOT IN (SELECT doc_id FROM once) ORDER BY CAST(10 AS DOUBLE) * score + salience DESC, doc_id LIMIT (SELECT greatest(0, target - (SELECT count(*) FROM once)) FROM p))
SELECT * FROM once UNION ALL SELECT * FROM more"""


@query(_balanced("l.rk > coalesce(had.n, 0)"))
def balance_full(spark, d):
    own = clips(spark, d)
    return balance.balanced(own, "species", "doc_id", "score", "salience", "cluster_id", target=own.count() // 2).select("doc_id", "species")


@query(_balanced("l.doc_id NOT IN (SELECT doc_id FROM chosen)"))
def balance_strict(spark, d):
    own = clips(spark, d)
    return balance.balanced(own, "species", "doc_id", "score", "salience", "cluster_id", target=own.count() // 2, mode="strict").select("doc_id", "species")


@query(f"""WITH {CLIPS}, p AS (SELECT count(*) // 2 AS target, (count(*) // 2) // count(DISTINCT species) AS cap FROM clips),
l AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY score DESC, salience DESC, doc_id) AS rk FROM clips),
dv AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY species, record ORDER BY rk) = 1 THEN 0 ELSE 1 END AS follows FROM l),
dp AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY follows, rk) AS pick FROM dv),
chosen AS (SELECT doc_id, species, record FROM dp WHERE pick <= (SELECT cap FROM p)), had AS (SELECT species, count(*) AS n FROM chosen GROUP BY species),
bf AS (SELECT l.doc_id, l.species FROM l LEFT JOIN had ON l.species = had.species WHERE rk > coalesce(had.n, 0)
  ORDER BY CAST(10 AS DOUBLE) * score + salience + CASE WHEN record NOT IN (SELECT record FROM chosen) THEN CAST(100 AS DOUBLE) ELSE 0 END DESC, l.doc_id LIMIT (SELECT greatest(0, target - (SELECT count(*) FROM chosen)) FROM p))
SELECT doc_id, species FROM chosen UNION ALL SELECT * FROM bf""")
def balance_legacy(spark, d):
    own = clips(spark, d)
    return balance.balanced_legacy(own, "species", "doc_id", "score", "salience", "record", target=own.count() // 2).select("doc_id", "species")


@query(f"WITH {CLIPS} SELECT doc_id, round(salience, 6) AS salience FROM clips ORDER BY clips.salience DESC, doc_id LIMIT (SELECT count(*) // 4 FROM clips)")
def trim_global(spark, d):
    own = clips(spark, d)
    return first_rows(own, own.count() // 4, F.desc("salience"), "doc_id").select("doc_id", F.round("salience", 6).alias("salience"))


@query(f"WITH {CLIPS} SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY salience DESC, doc_id) <= (SELECT count(*) // 100 * 100 FROM clips) THEN 'keep' ELSE 'quarantine' END AS status FROM clips")
def rms_topn_split(spark, d):
    return balance.top_split(clips(spark, d), "salience", "doc_id", step=100).select("doc_id", "status")


@query()
def cluster_within_group(spark, d):
    own = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("species"), "embedding")
    return clustering.cluster_within(own, "species", "vec_id", "embedding", [F.asc("vec_id")]).select("vec_id", "species", "cluster_id")


# Segments


@query(f"WITH {WINDOWS} SELECT user_id, start, rms FROM windows")
def sliding_rms(spark, d):
    return windows(spark, d).select("user_id", "start", "rms")


LOUDEST = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rms DESC, start) AS k FROM windows"


@query(f"WITH {WINDOWS} SELECT user_id, start, rms FROM ({LOUDEST}) WHERE k = 1")
def loudest_window(spark, d):
    return segments.loudest(windows(spark, d), "user_id").select("user_id", "start", "rms")


@query(f"WITH {WINDOWS} SELECT user_id, start, n < {WINDOW} AS is_short FROM ({LOUDEST}) WHERE k = 1 AND rms > 0")
def loudest_or_pad(spark, d):
    return segments.loudest(windows(spark, d), "user_id").where("rms > 0").select("user_id", "start", (F.col("n") < WINDOW).alias("is_short"))


@query(f"WITH {WINDOWS} SELECT user_id, start, rms < {LOUD} AS fallback FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rms < {LOUD}, rms DESC, start) AS k FROM windows) WHERE k <= 3")
def silence_filter_with_fallback(spark, d):
    return segments.above_or_best(windows(spark, d), "user_id", LOUD, 3).select("user_id", "start", "fallback")


@query(f"""WITH {WINDOWS}, used AS (SELECT user_id, start AS used FROM ({LOUDEST}) WHERE k = 1), loud AS (SELECT user_id, max(rms) >= {LOUD} AS loud FROM windows GROUP BY user_id),
fit AS (SELECT w.* FROM windows w JOIN loud USING (user_id) WHERE (rms >= {LOUD} OR NOT loud) AND NOT EXISTS (SELECT 1 FROM used u WHERE u.user_id = w.user_id AND abs(w.start - u.used) < {APART}))
SELECT user_id, start FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rms DESC, start DESC) AS k FROM fit) WHERE k = 1""")
def replacement_window(spark, d):
    w = windows(spark, d)
    used = segments.loudest(w, "user_id").select("user_id", F.col("start").alias("used"))
    return segments.replacement(w, used, "user_id", APART, LOUD).select("user_id", "start")


@query(f"""WITH {WINDOWS}, a AS (SELECT user_id, arg_min(start, (-rms, start)) AS x FROM windows GROUP BY 1),
b AS (SELECT user_id, any_value(x) AS x, arg_min(start, (-rms, start)) AS y FROM windows JOIN a USING (user_id) WHERE abs(start - x) >= {APART} GROUP BY 1),
c AS (SELECT user_id, arg_min(start, (-rms, start)) AS z FROM windows JOIN b USING (user_id) WHERE abs(start - x) >= {APART} AND abs(start - y) >= {APART} GROUP BY 1)
SELECT user_id, x AS start, 1 AS place FROM a UNION ALL SELECT user_id, y, 2 FROM b UNION ALL SELECT user_id, z, 3 FROM c""")
def greedy_separated_windows(spark, d):
    return segments.separated(windows(spark, d), "user_id", 3, APART).select("user_id", "start", "place")


@query("SELECT event_id, round(greatest(0, least(CAST(user_id % 100 AS DOUBLE), value - 3)), 6) AS start FROM events")
def clamp(spark, d):
    return table(spark, d, "events").select("event_id", F.round(X.clamp_start(F.col("user_id") % 100, "value"), 6).alias("start"))


def _waves(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user as one wave in [-1, 1]."""
    e = table(spark, d, "events").withColumn("top", F.max(F.abs("value")).over(Window.partitionBy("user_id")))
    pairs = e.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", (F.col("value") / F.col("top")).alias("v")))).alias("x"))
    return pairs.select("user_id", F.transform("x", lambda s: s["v"]).alias("y"))


WAVES = "e AS (SELECT user_id, event_id, value / max(abs(value)) OVER (PARTITION BY user_id) AS v, max(abs(value)) OVER (PARTITION BY user_id) AS top FROM events)"


@query(f"WITH {WAVES} SELECT user_id, round(sum(tanh(5 * v * 0.99) / 5), 4) AS total, round(max(tanh(5 * abs(v) * 0.99) / 5), 6) AS peak FROM e GROUP BY user_id")
def soft_limit(spark, d):
    y = _waves(spark, d).select("user_id", A.soft_limit("y").alias("y"))
    return y.select("user_id", F.round(A.total(F.col("y")), 4).alias("total"), F.round(A.peak("y"), 6).alias("peak"))


@query(f"WITH {WAVES} SELECT user_id, round(sum(v * 0.99 * 6 / (1 + 5 * abs(v * 0.99))), 4) AS total, round(max(abs(v) * 0.99 * 6 / (1 + 5 * abs(v * 0.99))), 6) AS peak FROM e GROUP BY user_id")
def curve_limit(spark, d):
    y = _waves(spark, d).select("user_id", A.curve_limit("y").alias("y"))
    return y.select("user_id", F.round(A.total(F.col("y")), 4).alias("total"), F.round(A.peak("y"), 6).alias("peak"))


# Near duplicates

NEAR = """
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
near AS (SELECT i, j, sim, place FROM (SELECT a.vec_id AS i, b.vec_id AS j, list_dot_product(a.e, b.e) AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.e, b.e) DESC, b.vec_id) AS place FROM v a, v b) WHERE place <= 6),
cand AS (SELECT i, j, sim FROM near JOIN v a ON a.vec_id = i JOIN v b ON b.vec_id = j WHERE j > i AND sim >= 0.35 AND a.label <> b.label)"""


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    own = table(spark, d, "embeddings")
    return own, neardup.neighbours(own, "vec_id", "embedding", unit=False)


def _candidates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    own, near = _near(spark, d)
    return own, neardup.candidates(near, own, "vec_id", "label", least=0.35)


@query(f"WITH {NEAR} SELECT i, j, round(sim, 6) AS sim, place FROM near")
def topk_neighbors(spark, d):
    return _near(spark, d)[1].select("i", "j", F.round("sim", 6).alias("sim"), "place")


@query(f"WITH {NEAR} SELECT i, j, round(sim, 6) AS sim FROM cand")
def neardup_candidates(spark, d):
    return _candidates(spark, d)[1].select("i", "j", F.round("sim", 6).alias("sim"))


@query(f"""WITH {NEAR}, f AS (SELECT vec_id, k, list_slice(e, k * 8 + 1, k * 8 + 8) AS x FROM v, range(8) t(k)), u AS (SELECT vec_id, k, x, sqrt(list_dot_product(x, x)) AS n FROM f),
s AS (SELECT i, j, greatest(-1, least(1, list_dot_product(a.x, b.x) / (a.n * b.n))) AS s FROM cand JOIN u a ON a.vec_id = i JOIN u b ON b.vec_id = j AND a.k = b.k)
SELECT i, j, round(avg(s), 6) AS mean_sim, round(min(s), 6) AS min_sim, round(quantile_cont(s, 0.05), 6) AS p5_sim, avg(s) >= 0.5 AS similar FROM s GROUP BY i, j""")
def pair_similarity_stats(spark, d):
    own, pairs = _candidates(spark, d)
    out = neardup.verified(pairs, own, "vec_id", "embedding", 8)
    return out.select("i", "j", *[F.round(c, 6).alias(c) for c in ("mean_sim", "min_sim", "p5_sim")], (F.col("mean_sim") >= 0.5).alias("similar"))


@query("""WITH x AS (SELECT vec_id, (k - 1) % 8 AS band, CAST(embedding[k] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(k))
SELECT vec_id, band, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM x GROUP BY vec_id, band""")
def vector_pooling(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("k", "v")).select("vec_id", (F.col("k") % 8).cast("long").alias("band"), F.col("v").cast("double").alias("v"))
    return x.groupBy("vec_id", "band").agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("std"))


@query("SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark, d):
    return neardup.exact_groups(table(spark, d, "documents"), "text", "doc_id")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    first = docs.groupBy("digest").agg(F.min_by(F.struct("doc_id", "source"), "doc_id").alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = docs.join(first, "digest").where(F.col("doc_id") > F.col("f.doc_id"))
    return both.select(F.col("f.doc_id").alias("i"), F.col("doc_id").alias("j"), F.col("f.source").alias("rec_i"), F.col("source").alias("rec_j"))


@query(f"WITH {PAIRS} SELECT i, j, rec_i = rec_j AS same_recordist, CASE WHEN rec_i = rec_j THEN i ELSE j END AS removed, CASE WHEN rec_i = rec_j THEN j ELSE i END AS kept FROM pairs")
def keep_rule(spark, d):
    return neardup.with_keep_rule(_pairs(spark, d), "i", "j").select("i", "j", "same_recordist", "removed", "kept")


@query(f"""WITH {PAIRS} SELECT i, j, CASE WHEN rec_i = rec_j THEN i ELSE j END AS removed,
  count(*) FILTER (rec_i = rec_j) OVER (PARTITION BY i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0 AS taken FROM pairs""")
def greedy_resolution(spark, d):
    return neardup.resolved(neardup.with_keep_rule(_pairs(spark, d), "i", "j"), ["i", "j"], "i", "j").select("i", "j", "removed", "taken")


# Quotas and splits

PRIORITY = "CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END"


@query(f"""WITH x AS (SELECT doc_id, lang, {PRIORITY} AS pr FROM documents), r AS (SELECT *, row_number() OVER (ORDER BY pr, CASE WHEN pr = 1 THEN md5(doc_id || '-42') ELSE '' END, doc_id) AS place FROM x WHERE pr IS NOT NULL)
SELECT doc_id, lang, place FROM r WHERE place <= (SELECT count(*) * 7 // 10 FROM documents)""")
def priority_quota(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    lang = F.col("lang")
    pr = F.when(lang == "en", 0).when(lang == "de", 1).when(lang == "es", 2).when(lang == "fr", 3)
    return quota.priority_quota(docs, pr, docs.count() * 7 // 10, "doc_id", sampled=1)


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id || '-42'), doc_id LIMIT (SELECT count(*) // 10 FROM documents)")
def hash_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return quota.hash_sample(docs, docs.count() // 10, "doc_id")


@query('SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 25 AS page, (row_number() OVER (ORDER BY doc_id) - 1) % 25 // 5 AS "row", (row_number() OVER (ORDER BY doc_id) - 1) % 5 AS col FROM documents')
def contact_sheet_pages(spark, d):
    return quota.pages(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '-42'), doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM labels WHERE quality IS NOT NULL)
SELECT doc_id, quality, CASE WHEN k <= floor(n * CAST(0.1 AS DOUBLE) + 0.5) THEN 'test' WHEN k <= 2 * floor(n * CAST(0.1 AS DOUBLE) + 0.5) THEN 'valid' ELSE 'train' END AS split FROM r""")
def stratified_split(spark, d):
    return quota.stratified_split(table(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")


# Metrics

CONFUSION = f"{SCORED}, c AS (SELECT count(*) FILTER (score > 0.5 AND label = 1) AS tp, count(*) FILTER (score > 0.5 AND label <> 1) AS fp, count(*) FILTER (score <= 0.5 AND label = 1) AS fn, count(*) FILTER (score <= 0.5 AND label <> 1) AS tn FROM scored)"


@query(f"WITH {CONFUSION} SELECT * FROM c")
def confusion(spark, d):
    return metrics.confusion(scored(spark, d))


@query(f"WITH {CONFUSION} SELECT round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END, 6) AS \"precision\", round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c")
def prf1(spark, d):
    return metrics.prf1(scored(spark, d)).select(*[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


CURVE = f"{SCORED}, g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM scored GROUP BY score), cu AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM g)"


@query(f"WITH {CURVE} SELECT round(sum(neg * (tp - CAST(pos AS DOUBLE) / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM cu")
def auc_rank(spark, d):
    return metrics.auc(scored(spark, d)).withColumn("auc", F.round("auc", 6))


@query(f"WITH {CURVE} SELECT round(sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / sum(pos), 6) AS average_precision FROM cu")
def avg_precision(spark, d):
    return metrics.average_precision(scored(spark, d)).withColumn("average_precision", F.round("average_precision", 6))


@query(f"WITH {CURVE} SELECT score, round(CAST(fp AS DOUBLE) / (SELECT sum(neg) FROM g), 6) AS fpr, round(CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM g), 6) AS tpr FROM cu")
def roc_points(spark, d):
    return metrics.roc_points(scored(spark, d)).select("score", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(f"WITH {CURVE} SELECT score, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS \"precision\", round(CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM g), 6) AS recall FROM cu")
def pr_points(spark, d):
    return metrics.pr_points(scored(spark, d)).select("score", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


SWEEP = f"{SCORED}, t AS (SELECT CAST(k AS DOUBLE) / 99 AS threshold FROM range(100) r(k)), sw AS (SELECT threshold, 2.0 * count(*) FILTER (score >= threshold AND label = 1) / (count(*) FILTER (score >= threshold) + count(*) FILTER (label = 1)) AS f1 FROM t, scored GROUP BY threshold)"


@query(f"WITH {SWEEP} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM sw")
def f1_threshold_sweep(spark, d):
    return metrics.f1_sweep(scored(spark, d)).select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query(f"WITH {SWEEP} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM sw ORDER BY sw.f1 DESC, sw.threshold LIMIT 1")
def best_threshold(spark, d):
    return metrics.best_threshold(scored(spark, d)).select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query("SELECT lang, round(avg(n_chars), 4) AS n_chars_mean, round(stddev(n_chars), 4) AS n_chars_std FROM documents GROUP BY lang")
def across_runs(spark, d):
    out = metrics.across_runs(table(spark, d, "documents"), "lang", "n_chars")
    return out.select("lang", F.round("n_chars_mean", 4).alias("n_chars_mean"), F.round("n_chars_std", 4).alias("n_chars_std"))


@query("SELECT m AS model, s AS seed FROM (VALUES ('small'), ('large')) a(m), (VALUES (42), (100), (786)) b(s)")
def run_matrix_rows(spark, d):
    return run_matrix(spark, ["small", "large"], [42, 100, 786])


# Corrections


def corrections_table(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    issue = F.when(n % 5 == 0, "wrong_onset").when(n % 5 == 1, "no_bird").when(n % 5 == 2, "Noise_dominated ").when(n % 5 == 3, "noise_dominated").otherwise("other")
    onset = F.when(n % 10 == 5, "").when(n % 5 == 0, (F.col("n_chars") * 10).cast("string")).when(n % 5 == 2, (F.col("n_chars") % 7000).cast("string")).otherwise("")
    name = F.concat(F.lit("xc"), (n % 97).cast("string"), F.lit("_"), F.when(n % 11 == 0, "U").otherwise("A"), F.lit("_"), ((n % 7) * 1000).cast("string"), F.lit(".wav"))
    return table(spark, d, "documents").select("doc_id", name.alias("clip_filename"), issue.alias("issue_type"), onset.alias("corrected_onset_ms"))


ISSUES = """
qa AS (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'wrong_onset' WHEN 1 THEN 'no_bird' WHEN 2 THEN 'noise_dominated' WHEN 3 THEN 'noise_dominated' ELSE 'other' END AS issue,
    CASE WHEN doc_id % 10 = 5 THEN '' WHEN doc_id % 5 = 0 THEN CAST(n_chars * 10 AS VARCHAR) WHEN doc_id % 5 = 2 THEN CAST(n_chars % 7000 AS VARCHAR) ELSE '' END AS onset FROM documents
)"""


@query(f"WITH {ISSUES} SELECT doc_id, CASE WHEN issue <> 'noise_dominated' THEN issue WHEN onset <> '' THEN 'wrong_onset' ELSE 'no_bird' END AS issue FROM qa")
def resolve_issue(spark, d):
    return corrections_table(spark, d).select("doc_id", X.resolved_issue("issue_type", "corrected_onset_ms").alias("issue"))


def _log(spark: SparkSession, d: str) -> DataFrame:
    rows = corrections_table(spark, d)
    parts = X.clip_parts("clip_filename")
    onsets = rows.select(parts.alias("p")).where("p is not null").select("p.id", "p.onset_ms").distinct()
    starts = F.explode(F.sequence(F.lit(0), F.lit(9000), F.lit(500))).alias("start_ms")
    w = onsets.select("id").distinct().select("id", F.lit("A").alias("grade"), starts).withColumn("start_ms", F.col("start_ms").cast("long"))
    w = w.withColumn("rms", (F.col("id").cast("long") * 31 + F.col("start_ms") * 7) % 101 / 5000.0)
    return corrections.applied(rows, onsets, w, "doc_id")


_CUT = "CASE WHEN list_contains({0}, {1}) THEN list_concat({0}[:list_position({0}, {1}) - 1], {0}[list_position({0}, {1}) + 1:]) ELSE {0} END"
LOG = f"""
{ISSUES}, parts AS (
  SELECT doc_id, CAST(doc_id % 97 AS VARCHAR) AS id, doc_id % 11 > 0 AS fits, doc_id % 7 * 1000 AS onset_ms, issue AS issue_type, try_cast(nullif(onset, '') AS BIGINT) AS fixed,
    CASE WHEN issue <> 'noise_dominated' THEN issue WHEN onset <> '' THEN 'wrong_onset' ELSE 'no_bird' END AS issue,
    'xc' || doc_id % 97 || CASE WHEN doc_id % 11 = 0 THEN '_U_' ELSE '_A_' END || doc_id % 7 * 1000 || '.wav' AS clip_filename FROM qa
), steps AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS step FROM parts WHERE fits),
held AS (SELECT id, list(DISTINCT onset_ms) AS have FROM steps GROUP BY id),
quiet AS (SELECT id, [s FOR s IN list_reverse_sort([{{'r': (CAST(id AS BIGINT) * 31 + k * 500 * 7) % 101, 's': CAST(k * 500 AS BIGINT)}} FOR k IN range(19)])] AS w FROM held),
loud AS MATERIALIZED (SELECT id, CASE WHEN len(list_filter(w, lambda x: x.r >= 5)) > 0 THEN list_filter(w, lambda x: x.r >= 5) ELSE w END AS w FROM quiet),
run(id, step, have, doc_id, result, spot) AS (
  SELECT id, CAST(0 AS BIGINT), have, CAST(-1 AS BIGINT), '', CAST(NULL AS BIGINT) FROM held
  UNION ALL
  SELECT id, step, CASE WHEN spot IS NOT NULL THEN list_append(cut, spot) WHEN result = 'removed_no_replacement' THEN cut ELSE have END, doc_id, result, spot FROM (
    SELECT *, CASE WHEN issue = 'wrong_onset' THEN CASE WHEN fixed IS NULL THEN 'skipped' ELSE 'corrected' END WHEN issue = 'no_bird' THEN CASE WHEN pick IS NULL THEN 'removed_no_replacement' ELSE 'replaced' END ELSE 'skipped' END AS result,
      CASE issue WHEN 'wrong_onset' THEN fixed WHEN 'no_bird' THEN pick END AS spot FROM (
      SELECT s.id, s.step, r.have, s.doc_id, s.issue, s.fixed, {_CUT.format("r.have", "s.onset_ms")} AS cut,
        list_filter(l.w, lambda x: len(list_filter(r.have, lambda o: o <> s.onset_ms AND abs(x.s - o) < 1500)) = 0)[1].s AS pick
      FROM run r JOIN steps s ON s.id = r.id AND s.step = r.step + 1 JOIN loud l ON l.id = r.id)))
, log AS (
  SELECT p.id, p.clip_filename, p.issue_type, r.result, CASE WHEN r.spot IS NULL THEN '' ELSE 'xc' || p.id || '_A_' || r.spot || '.wav' END AS new_filename,
    CASE WHEN r.result <> 'skipped' THEN '' WHEN p.issue = 'wrong_onset' THEN 'missing corrected_onset_ms' ELSE 'unknown issue_type: ' || p.issue_type END AS notes, p.doc_id AS seq FROM run r JOIN parts p ON p.doc_id = r.doc_id WHERE r.step > 0
  UNION ALL SELECT '', clip_filename, issue_type, 'error', '', 'file name doesn''t fit', doc_id FROM parts WHERE NOT fits
)"""


@query(f"WITH RECURSIVE {LOG} SELECT * FROM log")
def apply_corrections(spark, d):
    return _log(spark, d)


@query(f"""WITH RECURSIVE {LOG}, n AS (SELECT count(*) FILTER (result = 'corrected') AS corrected, count(*) FILTER (result = 'replaced') AS replaced, count(*) FILTER (result = 'removed_no_replacement') AS not_replaced, count(*) FILTER (result = 'skipped') AS skipped, count(*) FILTER (result = 'error') AS errors FROM log)
SELECT *, -not_replaced AS net_change, replaced - not_replaced AS net_change_compat FROM n""")
def net_change(spark, d):
    return corrections.summary(_log(spark, d))


# Names, files and tables of files

FILES = """
files AS (
  SELECT doc_id, lang, source, '/data/' || source || '/' || lang || '/rec.' || doc_id || CASE doc_id % 4 WHEN 0 THEN '.flac' WHEN 1 THEN '.WAV' WHEN 2 THEN '.txt' ELSE '.mp3' END AS path,
    CASE doc_id % 7 WHEN 0 THEN 'no score' WHEN 1 THEN ' b' WHEN 2 THEN 'C' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'Unrated' ELSE 'a' END AS raw, n_chars % 3 AS bytes
  FROM documents
)"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    ext = F.when(n % 4 == 0, ".flac").when(n % 4 == 1, ".WAV").when(n % 4 == 2, ".txt").otherwise(".mp3")
    raw = F.when(n % 7 == 0, "no score").when(n % 7 == 1, " b").when(n % 7 == 2, "C").when(n % 7 == 3, "").when(n % 7 == 5, "Unrated").when(n % 7 == 6, "a")
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "lang", F.lit("/rec."), n.cast("string"), ext)
    return table(spark, d, "documents").select("doc_id", "lang", "source", path.alias("path"), raw.alias("raw"), (F.col("n_chars") % 3).alias("bytes"))


@query(f"""WITH {FILES}, g AS (SELECT *, CASE doc_id % 7 WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 6 THEN 'A' ELSE 'U' END AS grade FROM files)
SELECT doc_id, grade, nullif(trim(raw), '') AS cleaned, 'xc' || doc_id || '_' || grade || '.flac' AS output, 'rec.' || doc_id AS stem, lang AS folder, source AS top, md5(path) AS cache FROM g""")
def file_names(spark, d):
    p = _files(spark, d)
    return p.select("doc_id", X.grade_of("raw").alias("grade"), X.cleaned("raw").alias("cleaned"), X.output_name(F.concat("doc_id", F.lit(".0")), "raw").alias("output"), X.stem("path").alias("stem"), X.folder("path").alias("folder"), X.top_folder("path", "/data").alias("top"), X.cache_key("path").alias("cache"))


@query(f"WITH {FILES} SELECT doc_id, CASE WHEN doc_id % 4 <> 2 AND bytes > 0 AND doc_id % 5 <> 0 THEN 1 ELSE 0 END AS valid FROM files WHERE lang <> 'fr'")
def valid_files(spark, d):
    name = F.concat(F.when(F.col("doc_id") % 5 == 0, ".").otherwise(""), X.base_name("path"))
    own = _files(spark, d).withColumn("folder", X.folder("path"))
    return tables.without_folders(own, ["fr"]).select("doc_id", tables.valid_audio(name, F.col("bytes")).cast("int").alias("valid"))


@query("SELECT event_id, CAST(round_even(event_id * 1000 / CAST(16000 AS DOUBLE), 0) AS BIGINT) AS rounded, event_id * 1000 // 16000 AS cut FROM events")
def onset_two_roundings(spark, d):
    return table(spark, d, "events").select("event_id", X.onset_ms("event_id").alias("rounded"), X.onset_ms_floor("event_id").alias("cut"))


@query("SELECT doc_id, round(0.0001 + (0.01 - 0.0001) * 0.5 * (1 + cos(pi() * least(doc_id / CAST(150 AS DOUBLE), 1))), 8) AS rate FROM documents")
def cosine_rate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(X.cosine_decay("doc_id", 150, 0.01, 0.0001), 8).alias("rate"))


@query("""SELECT 'flags' AS kind, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE n_chars % 3 = 0
UNION ALL SELECT 'classes', 'c.' || doc_id FROM documents WHERE n_chars % 27 NOT IN (23, 24)
UNION ALL SELECT 'categories', 'e.' || doc_id FROM documents WHERE n_chars % 5 <> 1 AND n_chars % 5 <> 3""")
def negative_manifests(spark, d):
    docs, n = table(spark, d, "documents"), F.col("n_chars")
    name = lambda lead: F.concat(F.lit(lead), "doc_id", F.lit(".wav"))
    flags = docs.select(F.col("doc_id").cast("string").alias("itemid"), (n % 3).alias("hasbird"))
    classes = docs.select(name("c.").alias("Dataset File Name"), (n % 27).alias("Class ID"))
    kinds = docs.select(name("e.").alias("filename"), F.when(n % 5 == 1, "rooster").when(n % 5 == 3, "chirping_birds").otherwise("rain").alias("category"))
    return hygiene.union_all([tables.negatives(m, k).select(F.lit(k).alias("kind"), "key") for k, m in (("flags", flags), ("classes", classes), ("categories", kinds))])


@query(f"""WITH {FILES}, s AS (SELECT doc_id // 2 AS id, CASE doc_id % 2 WHEN 0 THEN 'A' ELSE 'B' END AS g, '/f/' || lang || '/xc' || doc_id // 2 || '_' || CASE doc_id % 2 WHEN 0 THEN 'a' ELSE 'B' END || '.flac' AS path FROM files)
SELECT f.doc_id, (SELECT min(s.path) FROM s WHERE s.id = f.doc_id AND s.g = 'A') AS source_path FROM files f""")
def clip_source(spark, d):
    own = _files(spark, d)
    half = F.floor(F.col("doc_id") / 2).cast("string")
    path = F.concat(F.lit("/f/"), "lang", F.lit("/xc"), half, F.when(F.col("doc_id") % 2 == 0, "_a").otherwise("_B"), F.lit(".flac"))
    clips = own.select("doc_id", F.col("doc_id").cast("string").alias("id"), F.lit("a").alias("grade"))
    return tables.with_source(clips, own.select(path.alias("path"))).select("doc_id", "source_path")


@query(f"""WITH {META}, m AS (SELECT id, 'sp' || n_chars % 5 AS species, CASE doc_id % 2 WHEN 0 THEN 'de' END AS fetch_country FROM meta WHERE trim(id) <> '')
SELECT species, fetch_country, count(*) AS n, min(id) AS least FROM m GROUP BY ALL""")
def fetched_union(spark, d):
    rows = meta(spark, d).select("doc_id", "id", F.concat(F.lit("sp"), (F.col("n_chars") % 5).cast("string")).alias("en"), F.lit("x").alias("sono"))
    one = hygiene.with_provenance(rows.where("doc_id % 2 = 0"), "de")
    both = hygiene.drop_heavy(hygiene.union_all([one, rows.where("doc_id % 2 = 1")]))
    assert "sono" not in both.columns
    kept = hygiene.renamed(hygiene.require(hygiene.non_blank(both, "id", "en"), ["id", "en"]))
    return kept.groupBy("species", "fetch_country").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))


@query(f"""WITH {META}, k AS (SELECT doc_id % 50 AS key, doc_id, file, n_chars, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id DESC) AS rn FROM meta WHERE doc_id % 50 <> 7)
SELECT key, file, n_chars FROM k WHERE rn = 1""")
def csv_keyed(spark, d):
    import uuid

    path = f"{shared_dir(spark)}/mediasieve-csv-{uuid.uuid4().hex}"
    n = F.col("doc_id") % 50
    key = F.when(n == 7, "x7").otherwise(F.concat(F.lit(" "), n.cast("string")))
    sinks.write_csv(meta(spark, d).select("doc_id", key.alias("key"), "file", "n_chars"), path)
    rows = tables.csv_checked(spark, path, ["key", "file"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    last = tables.keyed(rows, "key", ["doc_id"]).select("key", "file")
    typed = tables.csv_typed(spark, path, "doc_id long, key string, file string, n_chars long").select(F.trim("key").try_cast("long").alias("key"), "doc_id", "n_chars")
    newest = hygiene.keep_last(typed.where("key is not null"), ["key"], ["doc_id"]).select("key", "n_chars")
    return last.join(newest, "key")


@query(f"WITH {CLIPS} SELECT count(*) AS n FROM (SELECT DISTINCT species, cluster_id FROM clips WHERE cluster_id - 1 >= 0)")
def cluster_total(spark, d):
    return clustering.cluster_counts(clips(spark, d).withColumn("cluster_id", F.col("cluster_id") - 1), "species")


@query(f"""WITH {CLIPS}, s AS (SELECT species, country FROM clips), x AS (SELECT species, count(*) AS n FROM s GROUP BY 1)
SELECT 'by_country' AS part, country AS name, count(*) AS n FROM s GROUP BY 2 UNION ALL SELECT 'distinct_species', '', count(*) FROM x
UNION ALL (SELECT 'top', species, n FROM x ORDER BY n DESC, species LIMIT 10) UNION ALL (SELECT 'bottom', species, n FROM x ORDER BY n, species LIMIT 10)
UNION ALL SELECT 'exclusive', country, count(DISTINCT species) FROM s GROUP BY 2""")
def metadata_report(spark, d):
    own = clips(spark, d).select(F.col("species").alias("en"), F.col("country").alias("cnt"))
    lost = own.select(F.lit("Unknown").alias("en"), "cnt").unionByName(own.select("en", F.lit(" ").alias("cnt")))
    parts = hygiene.statistics(own.unionByName(lost))
    named = {"by_country": ("cnt", "n"), "distinct_species": (None, "n"), "top": ("en", "n"), "bottom": ("en", "n"), "exclusive": ("cnt", "n_exclusive")}
    return hygiene.union_all([parts[p].select(F.lit(p).alias("part"), (F.col(k) if k else F.lit("")).alias("name"), F.col(v).alias("n")) for p, (k, v) in named.items()])


# Arrays

SAMPLES = "s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n, value / max(abs(value)) OVER (PARTITION BY user_id) AS v FROM events)"


def _weighted(y: Column) -> Column:
    """Sum of an array's elements times their places, so that places count."""
    return F.round(A.total(F.transform(y, lambda v, k: v * (k + 1))), 4)


@query(f"""WITH {SAMPLES}, r AS (SELECT user_id, sum(v * (t.k + 1)) AS x FROM s, range(200) t(k) WHERE s.k = t.k % s.n + 1 GROUP BY user_id)
SELECT s.user_id, round(sum(v * k) FILTER (k <= 60), 4) AS cut, round(max(r.x), 4) AS repeated, round(sum((v - lo) / (hi - lo) * k), 4) AS scaled, round(sum(v * k) / sqrt(sum(v * v)), 4) AS unit,
  round(sum(CASE WHEN k % 3 = 0 THEN 0 ELSE v * k END), 4) AS finite, max(abs(v * (s.user_id % 2))) >= 0.9999 AS clipped, round(sum((v + v * v) / 2 * k), 4) AS mono, round(sqrt(sum(v * v) / count(*)), 6) AS rms
FROM (SELECT *, min(v) OVER (PARTITION BY user_id) AS lo, max(v) OVER (PARTITION BY user_id) AS hi FROM s) s JOIN r ON r.user_id = s.user_id GROUP BY s.user_id""")
def wave_shapes(spark, d):
    y = _waves(spark, d)
    bad = F.transform("y", lambda v, k: F.when((k + 1) % 6 == 0, float("nan")).when((k + 1) % 3 == 0, float("-inf")).otherwise(v))
    return y.select(
        "user_id",
        _weighted(A.fitted("y", 60)).alias("cut"),
        _weighted(A.repeated("y", 200)).alias("repeated"),
        _weighted(A.min_max("y")).alias("scaled"),
        _weighted(A.unit("y")).alias("unit"),
        _weighted(A.finite(bad)).alias("finite"),
        A.clipped(F.transform("y", lambda v: v * (F.col("user_id") % 2))).alias("clipped"),
        _weighted(A.mono("y", F.transform("y", lambda v: v * v))).alias("mono"),
        F.round(A.rms("y"), 6).alias("rms"),
    )


@query("""WITH x AS (SELECT vec_id, (k - 1) // 8 AS band, CAST(embedding[k] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(k))
SELECT vec_id, band, round(avg(v), 4) + 0 AS mean, round(stddev_pop(v), 4) AS std FROM x GROUP BY vec_id, band""")
def pooled_bands(spark, d):
    @F.pandas_udf("array<float>")
    def pooled(vs: pd.Series) -> pd.Series:
        return vs.map(lambda v: dsp.pooled(np.asarray(v, np.float64).reshape(8, 8)))

    p = table(spark, d, "embeddings").select("vec_id", pooled("embedding").alias("p")).select("vec_id", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("band"))
    at = lambda k: F.round(F.get("p", k.cast("int")).cast("double"), 4) + 0.0
    return p.select("vec_id", "band", at(F.col("band")).alias("mean"), at(F.col("band") + 8).alias("std"))


# Pairs


@query(f"""WITH {NEAR}, m AS (SELECT vec_id, CASE WHEN vec_id % 5 > 0 THEN CAST(vec_id % 3 AS DOUBLE) END AS dur FROM embeddings)
SELECT c.i, c.j, round(sim, 6) AS sim, a.dur AS dur_i, b.dur AS dur_j FROM cand c JOIN m a ON a.vec_id = c.i JOIN m b ON b.vec_id = c.j WHERE abs(a.dur - b.dur) <= 1 OR (a.dur IS NULL AND b.dur IS NULL)""")
def candidates_by_duration(spark, d):
    own, near = _near(spark, d)
    timed = own.withColumn("dur", F.when(F.col("vec_id") % 5 > 0, (F.col("vec_id") % 3).cast("double")))
    return neardup.candidates(near, timed, "vec_id", "label", "dur", 0.35).select("i", "j", F.round("sim", 6).alias("sim"), "dur_i", "dur_j")


SHIFTS = "CASE vec_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0.00000001 WHEN 2 THEN 0.015 ELSE 0.1 END"


@query(f"""WITH f AS (SELECT vec_id, k, CAST(embedding[k] AS DOUBLE) AS x, CAST(embedding[k] AS DOUBLE) + CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * CAST({SHIFTS} AS DOUBLE) AS y FROM embeddings, range(1, 65) t(k)),
s AS (SELECT vec_id, (k - 1) // 8 AS w, sum(x * y) / sqrt(sum(x * x) * sum(y * y)) AS s, max(abs(x - y) - 0.0000001 - 0.00001 * abs(y)) AS far FROM f GROUP BY ALL),
g AS (SELECT vec_id, avg(s) AS m, min(s) AS l, quantile_cont(s, 0.05) AS p, max(far) <= 0 AS close FROM s GROUP BY vec_id)
SELECT vec_id AS i, CASE WHEN close OR m >= 0.999 THEN 'perfect' WHEN m >= 0.997 AND l >= 0.985 AND p >= 0.992 THEN 'near' END AS kind FROM g""")
def pair_kinds(spark, d):
    own = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    n = F.col("vec_id")
    shift = F.when(n % 4 == 0, 0.0).when(n % 4 == 1, 0.00000001).when(n % 4 == 2, 0.015).otherwise(0.1)
    moved = own.withColumn("v", F.transform("v", lambda x, k: x + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * shift)).withColumn("vec_id", -n - 1)
    pairs = own.select(n.alias("i"), (-n - 1).alias("j"))
    return neardup.verified(pairs, own.unionByName(moved), "vec_id", "v", 8).select("i", "kind")


@query(f"""WITH {META}, {PAIRS}, m AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 44100 END AS sr,
  coalesce(CAST(CASE doc_id % 7 WHEN 0 THEN 2 WHEN 1 THEN 65 WHEN 2 THEN 3600 WHEN 6 THEN n_chars % 60 END AS DOUBLE), 0) AS s FROM meta)
SELECT i, j, a.sr AS sr_i, b.sr AS sr_j, a.sr = b.sr AS sample_rate_match, a.s AS seconds_i, b.s AS seconds_j FROM pairs JOIN m a ON a.doc_id = i JOIN m b ON b.doc_id = j""")
def pair_differences(spark, d):
    n = F.col("doc_id")
    known = meta(spark, d).withColumn("smp", F.when(n % 3 == 0, "16000").when(n % 3 == 1, "44100").otherwise("n/a"))
    return neardup.differences(_pairs(spark, d).select("i", "j"), known, "doc_id").select("i", "j", "sr_i", "sr_j", "sample_rate_match", "seconds_i", "seconds_j")


@query(f"""WITH {PAIRS}, k AS (SELECT *, CASE WHEN rec_i = rec_j THEN i ELSE j END AS removed, CASE WHEN rec_i = rec_j THEN j ELSE i END AS kept FROM pairs)
SELECT 'near | ' || removed || ' | ' || kept || ' | near duplicate (0.9900); ' || CASE WHEN rec_i = rec_j THEN 'one recordist (' || rec_i || '): newer XC' || kept || ' kept, older XC' || removed || ' removed'
  ELSE 'recordists differ (''' || rec_i || ''', ''' || rec_j || '''): older XC' || kept || ' kept, newer XC' || removed || ' removed' END AS line FROM k""")
def duplicate_report(spark, d):
    pairs = _pairs(spark, d).withColumns({"sim": F.lit(0.99), "kind": F.lit("near")})
    return neardup.report(neardup.with_keep_rule(pairs, "i", "j", sim="sim"))


@query(f"""WITH RECURSIVE {NEAR}, o AS MATERIALIZED (SELECT i, j, (i + j) % 3 = 0 AS second, row_number() OVER (ORDER BY sim DESC, i, j) AS rn FROM cand),
run(rn, i, j, removed, taken, gone) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), false, CAST([] AS BIGINT[])
  UNION ALL
  SELECT o.rn, o.i, o.j, CASE WHEN second THEN o.j ELSE o.i END, NOT list_contains(gone, o.i) AND NOT list_contains(gone, o.j),
    CASE WHEN NOT list_contains(gone, o.i) AND NOT list_contains(gone, o.j) THEN list_append(gone, CASE WHEN second THEN o.j ELSE o.i END) ELSE gone END
  FROM run JOIN o ON o.rn = run.rn + 1)
SELECT i, j, removed, taken FROM run WHERE rn > 0""")
def greedy_resolution_chains(spark, d):
    pairs = _candidates(spark, d)[1].withColumn("removes", F.when((F.col("i") + F.col("j")) % 3 == 0, "j").otherwise("i")).withColumn("least", -F.col("sim"))
    out = neardup.resolved(pairs, ["least", "i", "j"], "i", "j")
    return out.select("i", "j", F.when(F.col("removes") == "j", F.col("j")).otherwise(F.col("i")).alias("removed"), "taken")


# Streaming


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, d):
    import uuid

    base = f"{shared_dir(spark)}/mediasieve-stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    # A pattern, as the table may be one file.
    one = lambda: ingest.file_stream(spark, f"{d}/event[s].parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    # Each event comes twice, from two sources.
    out = ingest.deduplicated(one().unionByName(one()), ["event_id"], "ts").select("event_id", "user_id", "event_type")
    ingest.append_to(out, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{base}/out")
