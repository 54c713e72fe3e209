"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, target / size of the source: a whole part and a
fraction. The fractions are made 0 or 1 pairwise: of two documents of a source, one takes words (size times fraction)
from the other until one of them is integral; which of the two ways is drawn so that neither's expectation changes. The
words in play stay the same, so sums are kept. Each leaf of a tree rounds some thousand documents, the largest first,
and hands on the one that stays open, by then a small one as a rule; inner nodes round what their children hand on. The
one document of a source that stays open at its root is taken where its fraction is a half or more: a source misses its
target by half that document's size at most. So the expectation holds for every document but that one, whose copies may
be off by up to a half.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, fresh, ranked, repeated, settle, word_count

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET, MOST = 1.5, 2.0
#: Documents of a leaf; nodes that an inner node combines.
LEAF_DOCS, FAN_IN = 4096, 64
_OPEN = "source string, rank long, leaf long, doc_id long, size long, rows long, whole long, extra long, part double, pick long, done boolean"


def source_targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """sources (source, source_size, ...) with rank, weight and target.

    Weights repeat over the sources in code point order, null last. They share budget times all sizes; a target stops at
    most times its source's size and the excess is shared anew by weight, until none is above.
    """
    own = ranked(sources, F.col("source").asc_nulls_last(), start=0)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    own = settle(own.withColumn("weight", pick))
    total = own.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1  # words for each unit of weight
    while True:
        over = (F.col("weight") * share >= most * F.col("source_size")) if capped >= 0 else F.lit(False)
        n, held, left = own.agg(F.sum(over.cast("long")), F.sum(F.when(over, most * F.col("source_size")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n is None or not left:
            break
        if n == capped:
            break
        capped, share = n, max(share, (budget * total - held) / left)
    over = F.col("weight") * share >= most * F.col("source_size")
    return own.withColumn("target", F.when(over | F.lit(not total), most * F.col("source_size").cast("double")).otherwise(F.col("weight") * share))


def pivot(size: np.ndarray, part: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Fractions rounded pairwise so that sum(size * part) stays the same; the fractions, and the index of the one left open or -1."""
    part = part.copy()
    rng = np.random.Generator(np.random.PCG64(seed & 0x7FFFFFFFFFFFFFFF))
    draws = rng.random(len(part))
    at = -1
    for k in range(len(part)):
        if not 1e-12 < part[k] < 1 - 1e-12:
            part[k] = round(part[k])
            continue
        if at < 0:
            at = k
            continue
        wa, wk = size[at], size[k]
        up = min(part[at] * wa, (1 - part[k]) * wk)  # words that k can take from the open one
        down = min(part[k] * wk, (1 - part[at]) * wa)
        move = up if draws[k] * (up + down) < down else -down
        a, b = part[at] - move / wa, part[k] + move / wk
        if abs(a - round(a)) < 1e-9:
            part[at], a = round(a), -1
        if abs(b - round(b)) < 1e-9:
            part[k], b = round(b), -1
        if a >= 0:
            part[at] = a
        if b >= 0:
            part[k] = b
        at = at if a >= 0 else k if b >= 0 else -1
    return part, at


def _node(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rounds the documents of a node, the largest first; one at most stays open."""
    pdf = pdf.sort_values(["size", "pick", "doc_id"], ascending=[False, True, True], kind="stable", na_position="last").reset_index(drop=True)
    part, at = pivot(pdf["size"].to_numpy(float), pdf["part"].to_numpy(float), int(pdf["pick"].iloc[0]))
    done = np.ones(len(pdf), bool)
    if at >= 0:
        done[at] = False
    pdf["part"], pdf["done"] = part, done
    return pdf


def _rounded(df: DataFrame, id_col: str, source_col: str, text_col: str, weights, budget: float, most: float, seed: int) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, rows, whole, extra): for each distinct (id, source, text) how many rows it has, the copies that each of them gets, and how many of them get one more."""
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_col).alias("text_hash"), word_count(F.col(text_col)).alias("size"))
    own = settle(own.groupBy("doc_id", "source", "text_hash", "size").agg(F.count(F.lit(1)).alias("rows")))
    sources = own.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = settle(source_targets(sources, weights, budget, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    pick = F.xxhash64(F.lit(seed), "doc_id", "text_hash", "size", "source")
    deal = F.pmod(F.xxhash64("pick", F.lit(seed)), F.ceil(F.col("n") / LEAF_DOCS))
    known = targets.select(F.col("source").alias("_s"), "rank", "n", "source_size", "target")
    docs = own.join(known, own.source.eqNullSafe(known._s)).drop("_s").withColumn("ratio", ratio).withColumn("pick", pick)
    share = F.when(F.col("size") > 0, F.col("rows") * (F.col("ratio") - F.floor("ratio"))).otherwise(0.0)
    docs = docs.withColumn("share", share)
    docs = docs.select("source", "rank", deal.cast("long").alias("leaf"), "doc_id", "size", "rows", F.floor("ratio").cast("long").alias("whole"), F.floor("share").cast("long").alias("extra"), (F.col("share") - F.floor("share")).alias("part"), "pick", F.lit(False).alias("done"), "text_hash")
    kinds = _OPEN + ", text_hash long"
    level = settle(docs.groupBy("rank", "leaf").applyInPandas(_node, kinds))
    out = level.where("done")
    leaves = targets.agg(F.max(F.ceil(F.col("n") / LEAF_DOCS))).first()[0] or 0
    while leaves > 1:
        leaves = -(-leaves // FAN_IN)
        up = level.where("not done").withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("long"))
        level = settle(up.groupBy("rank", "leaf").applyInPandas(_node, kinds))
        out = out.union(level.where("done"))
    # The last open document of a source: the nearer of both.
    out = out.union(level.where("not done").withColumn("part", F.when(F.col("part") >= 0.5, 1.0).otherwise(0.0)))
    known = targets.select("rank", "source_size", "target")
    out = out.join(known, "rank").withColumn("extra", F.col("extra") + F.col("part").cast("long"))
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", "rows", "whole", "extra")


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = 7) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies long): one row for each row of df.

    copies: how often the mix takes the document; it is the whole part of target / source_size or one more. A null text
    has size 0 and, like any document without words, no copies beyond the whole part. A null source is a source; null and
    repeated ids are rows of their own. Rows that repeat (id, source, text) are rounded as one, and their copies dealt
    out among them, so however many there are, a leaf holds them once. The same input gives the same copies. An empty
    table gives no rows.
    """
    out = _rounded(df, id_col, source_col, text_col, weights, budget, most, seed)
    more = F.array(F.struct(F.col("extra").alias("times"), (F.col("whole") + 1).alias("copies")), F.struct((F.col("rows") - F.col("extra")).alias("times"), F.col("whole").alias("copies")))
    out = out.select("doc_id", "text_hash", "source", "size", "source_size", "target", F.explode(more).alias("_x"))
    return repeated(out.select("doc_id", "text_hash", "source", "size", "source_size", "target", "_x.copies", F.col("_x.times").alias("_times")), "_times")


def take(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = 7) -> DataFrame:
    """The mix itself: the rows of df, each as often as its copies say. Columns as in df; an empty table gives no rows.

    A source's whole copies meet its rows by source; only documents with one copy more, and rows that repeat, are named.
    """
    found = settle(_rounded(df, id_col, source_col, text_col, weights, budget, most, seed))
    whole = settle(found.groupBy("source").agg(F.max("whole").alias("_whole")).withColumnRenamed("source", "_of"))
    named = settle(found.where("extra > 0 or rows > 1").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), F.col("rows").alias("_rows"), F.col("extra").alias("_extra")))
    times, mark, count = fresh(df, "_times"), fresh(df, "_mark"), fresh(df, "_count")
    source = df[source_col].cast("string")
    keys, base = few(named), few(whole)
    same = df[id_col].cast("long").eqNullSafe(keys["_id"]) & source.eqNullSafe(keys["_source"]) & (F.xxhash64(df[text_col]) == keys["_hash"])
    joined = df.join(keys, same, "left").join(base, source.eqNullSafe(base["_of"]))
    joined = joined.select(*[df[c] for c in df.columns], (base["_whole"] * F.coalesce(keys["_rows"], F.lit(1)) + F.coalesce(keys["_extra"], F.lit(0))).cast("long").alias(times), keys["_hash"].alias(mark), F.coalesce(keys["_rows"], F.lit(1)).alias(count))
    out = joined.where(F.col(count) == 1)
    if not named.where("_rows > 1").isEmpty():  # rows that repeat share their copies: one of them stands for all
        out = out.union(joined.where(F.col(count) > 1).dropDuplicates([id_col, source_col, mark]))
    return repeated(out.drop(mark, count), times)


def result(df: DataFrame) -> DataFrame:
    return mixed(df).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
