"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components, labels_of
from ..storage import discard, ranked, settle, shared_dir, sparing

__all__ = ["ascii_lower", "components", "discard", "few", "fresh", "labels_of", "ranked", "repeated", "settle", "shared_dir", "sparing", "table", "unsigned_hex", "with_keys", "without", "word_count"]

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows and bytes of a batch that goes to Python, at most: a worker holds a few batches of whole texts.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; bounds the session's Arrow batches, as texts may be long."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with underscores behind it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unsigned_hex(c: Column) -> Column:
    """A 64-bit value as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else kept; texts of ASCII alone take the fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_count(c: Column) -> Column:
    """Number of WORD matches (null: 0): each word becomes one mark, the rest goes."""
    marks = F.regexp_replace(F.regexp_replace(c, WORD, "w"), "[^w]+", "")
    return F.coalesce(F.length(marks).cast("long"), F.lit(0).cast("long"))


#: Elements of an array that stands for repeats, at most.
_REPEATS = 10_000


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as the column times says, without that column; arrays stay short however often a row repeats."""
    outer, inner = fresh(df, "_outer"), fresh(df, "_inner")
    zero, step = F.lit(0).cast("long"), F.lit(_REPEATS).cast("long")
    own = df.where(F.col(times) > 0).withColumn(outer, F.explode(F.sequence(zero, F.col(times) - 1, step)))
    count = F.least(F.col(times) - F.col(outer), step)
    return own.withColumn(inner, F.explode(F.sequence(F.lit(1).cast("long"), count))).drop(times, outer, inner)


#: Keys (an id and a hash each) that are broadcast, at most, so that texts need not move; more meet the texts in a shuffle.
FEW_KEYS = 500_000


def few(keys: DataFrame) -> DataFrame:
    """keys, a settled narrow table, to be broadcast if they are FEW_KEYS at most."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def _same(df: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> Column:
    return df[id_col].cast("long").eqNullSafe(keys["_key_id"]) & (F.xxhash64(df[text_col]) == keys["_key_hash"])


def _keys(keys: DataFrame) -> DataFrame:
    return few(settle(keys.select(F.col("doc_id").cast("long").alias("_key_id"), F.col("text_hash").alias("_key_hash")).distinct()))


def without(df: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of df whose id and text are not in keys (doc_id, text_hash); a null id is an id."""
    own = _keys(keys)
    return df.join(own, _same(df, own, id_col, text_col), "left_anti")


def with_keys(df: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of df whose id and text are in keys (doc_id, text_hash); a null id is an id."""
    own = _keys(keys)
    return df.join(own, _same(df, own, id_col, text_col), "left_semi")
