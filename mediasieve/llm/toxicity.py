"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words and the beginnings of its words, hashed to buckets. Every bucket that a bounded labelled sample
bears out gets a linear weight and a vector of factors, however many there are; a bucket that is as frequent under both
labels as chance may have it has zeros. The product of two terms' vectors weighs the pair, so that an insult together with a
mention of a group can weigh more than both alone.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, settle
from .labelled import fit_machine, remainder, sample, sigmoid, thinned

#: Labelled rows of either label to fit on, at most; buckets; standard errors by which a bucket's two shares differ, at least (by chance alone none of all buckets passes 6); lengths of word beginnings.
PER_CLASS, BUCKETS, SIGNIFICANT, HEADS = 4000, 1 << 22, 6.0, (4, 5, 6)
#: Words whose buckets a worker remembers, at most.
REMEMBERED = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def buckets(word: str) -> tuple[int, ...]:
    """Buckets of a lower-cased word: itself, and its beginnings (longer words only)."""
    out = [zlib.crc32(b"w" + word.encode())]
    out += [zlib.crc32(b"%d" % n + word[:n].encode()) for n in HEADS if len(word) > n]
    return tuple(x % BUCKETS for x in out)


def terms(text: str | None, known: dict[str, tuple[int, ...]], index: dict[int, int] | None = None) -> set[int]:
    """Distinct buckets of a whole text, or their places in index where there is one."""
    out: set[int] = set()
    for word in set(_WORD.findall((text or "").lower())):
        got = known.get(word)
        if got is None:
            if len(known) >= REMEMBERED:
                known.clear()
            got = buckets(word)
            if index is not None:
                got = tuple(index[x] for x in got if x in index)
            known[word] = got
        out.update(got)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: int = 5) -> dict:
    """Model from at most PER_CLASS rows of either label whose crc32 of the id modulo held_out isn't 0. With one label or no rows: a constant."""
    picked = sample(labels, label, PER_CLASS, remainder("doc_id", held_out) != 0)
    own = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("y", "text")  # 2 * PER_CLASS rows at most are broadcast

    def listed(batches):
        known: dict = {}
        for b in batches:
            found = [np.fromiter(terms(t.as_py(), known), np.int32) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], ["y", "terms"])

    own = settle(own.mapInArrow(listed, "y int, terms array<int>"))
    n, n1 = own.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n1 or n1 == n:
        return {"index": {}, "bias": -6.0 if not n1 else 6.0, "w": np.zeros(0, np.float32), "v": np.zeros((0, 1), np.float32)}
    n0 = n - n1
    seen = own.select("y", F.explode("terms").alias("t")).groupBy("t").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    both = (F.col("a") + F.col("b")) / n
    error = F.sqrt(both * (1 - both) * (1 / n0 + 1 / n1))
    told = seen.where(F.abs(F.col("a") / n1 - F.col("b") / n0) > SIGNIFICANT * error).orderBy("t")
    index = {r["t"]: k for k, r in enumerate(told.collect())}  # terms of 2 * PER_CLASS rows at most

    def kept(batches):
        for b in batches:
            found = [[index[t] for t in x.as_py() if t in index] for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32()))], ["y", "terms"])

    rows = sorted((r["y"], tuple(sorted(r["terms"]))) for r in own.mapInArrow(kept, "y int, terms array<int>").collect())  # 2 * PER_CLASS rows at most
    x = np.zeros((len(rows), max(1, len(index))), np.float32)
    for k, (_, found) in enumerate(rows):
        x[k, list(found)] = 1
    y = np.array([r[0] for r in rows], np.float32)
    # Texts often hold many signs, of which the model would weigh each a little; a thinned copy of every row, of either label, makes few enough.
    bias, w, v = fit_machine(np.concatenate([x, thinned(x)]), np.concatenate([y, y]))
    return {"index": index, "bias": bias, "w": w, "v": v}


def scored(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs without text_col, with score (0 to 1). A null or empty text scores as one without terms; a column called score is replaced."""
    names = [c for c in docs.columns if c not in (text_col, "score")]
    own = docs.select(*names, F.col(text_col).alias(fresh(docs, "_text")))
    schema = docs.select(*names).schema.add("score", "double")

    def run(batches):
        known: dict = {}
        index, w, v = model["index"], model["w"], model["v"]
        squares = (v * v).sum(1)
        for b in batches:
            out = []
            for t in b.column(len(names)):
                at = np.fromiter(sorted(terms(t.as_py(), known, index)), np.int64)
                z = model["bias"]
                if len(at):
                    inner = v[at].sum(0, dtype=np.float64)
                    z += w[at].sum(dtype=np.float64) + 0.5 * (inner @ inner - squares[at].sum(dtype=np.float64))
                out.append(float(sigmoid(np.float64(z))))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(out, pa.float64())], [*names, "score"])

    return own.mapInArrow(run, schema)


def result(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns; a null id is held out."""
    own = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return scored(own, train(docs, labels)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
