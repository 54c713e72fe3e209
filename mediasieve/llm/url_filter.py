"""URL filters: host-suffix and path-prefix expressions of each URL meet rules by a short hash prefix alone; where one meets, the full digests decide.

A rule is a host and the beginning of a path; it fits its host and all subdomains. Of the rules that fit the longest wins
(host and path together; of equal ones that with the longer host). A URL without a rule gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, repeated, settle

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DEFAULT = "allow"
#: Bits of the hash prefix; rules that are broadcast at most, more are joined by a shuffle; parts that each rule is dealt to there, as all pages of a domain meet it.
PREFIX_BITS, BROADCAST_RULES, SALTS = 32, 500_000, 64


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: between the first :// and /, ?, # or the end, A-Z lower-cased; then up to ?, # or the end. Null or no ://: both empty."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(found, parts, 1)), F.regexp_extract(found, parts, 2)


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every suffix of the host's labels with every prefix of the path of one of the lengths."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    fit = F.filter(F.array(*[F.lit(k) for k in lengths]).cast("array<int>"), lambda k: k <= F.char_length(path))
    prefixes = F.transform(fit, lambda k: F.substring(path, F.lit(1), k))
    each = F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p)))
    return F.array_distinct(F.flatten(each))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def short(expression: Column, bits: int) -> Column:
    """The first bits of an expression's 64-bit hash, as a number."""
    return F.shiftrightunsigned(F.xxhash64(expression), 64 - bits)


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def judged(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT, prefix_bits: int | None = None) -> DataFrame:
    """(id, url, host, path, rule, verdict): one row for each row of df; rule is null where none fits.

    A null URL, or one without ://, has an empty host and path and gets the default. Rules with a null part are ignored;
    of two rules for one host and path block wins. Repeated rows give repeated rows; other columns are ignored. An empty
    table gives no rows; without rules all get the default.
    """
    bits = prefix_bits or PREFIX_BITS
    own = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    same = F.concat("host", F.lit("\n"), "path")
    own = settle(own.select("verdict", F.concat("host", "path").alias("rule"), F.char_length("host").alias("host_n"), F.char_length("path").alias("path_n"), digest(same).alias("digest"), short(same, bits).alias("prefix")))
    lengths = sorted(r[0] for r in own.select("path_n").distinct().collect())  # as many as the longest path has characters at most
    host, path = split_url(F.col(url_col))
    pages = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("host"), path.alias("path"))
    # A null expression first: the row that keeps a page without rules.
    each = F.concat(F.array(F.lit(None).cast("string")), expressions(F.col("host"), F.col("path"), lengths or [0]))
    flat = pages.withColumn("_x", F.explode_outer(each)).withColumn("_prefix", F.when(F.col("_x").isNotNull(), short(F.col("_x"), bits)))
    known = own.select("prefix", "digest", F.struct((F.col("host_n") + F.col("path_n")).alias("n"), "host_n", "rule", "verdict").alias("found"))
    if own.count() <= BROADCAST_RULES:
        met = flat.join(F.broadcast(known), F.col("_prefix") == F.col("prefix"), "left")
    else:
        known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        # Rows without an expression meet nothing: they are dealt out too, by a prefix that no rule has.
        flat = flat.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int")).withColumn("_prefix", F.coalesce("_prefix", F.lit(-1).cast("long")))
        met = flat.join(known, (F.col("_prefix") == F.col("prefix")) & (F.col("_salt") == F.col("salt")), "left")
    # The digests are compared where prefixes have met, not as a second key of the join.
    confirmed = F.when(F.col("digest").isNotNull() & (digest(F.col("_x")) == F.col("digest")), F.col("found"))
    met = met.select("_id", "_url", "host", "path", "_x", confirmed.alias("found"))
    # One prefix may meet several rules: the row that counts a page has none, and so meets none.
    best = met.groupBy("_id", "_url", "host", "path").agg(F.max("found").alias("found"), F.sum(F.col("_x").isNull().cast("long")).alias("copies"))
    return repeated(best, "copies").select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "host", "path", F.col("found.rule").alias("rule"), F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"))


def result(pages: DataFrame) -> DataFrame:
    return judged(pages, rule_table(pages.sparkSession)).drop("url")


ORACLE_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
  SELECT rid, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rhost) + length(rpath) DESC) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.rid = m.rid AND m.k = 1
"""
