"""Quality classifier with hierarchical empirical Bayes.

A logistic model of a text's shape and of its words gives each document's evidence; of the words it knows, by hashed
term, the log odds among labelled documents. A site's counts are its labelled documents by their label and the others by
their evidence. A path's (source and language) mean is shrunk towards that of its host (source), and the host's towards the
mean of all documents, by Beta priors whose strengths come from the spread of the means (method of moments): a site with
few documents says little. A document's posterior log odds are its evidence plus what its path, the document itself left
out, is better or worse than all.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, without
from .labelled import fit_logistic, remainder, sample, sigmoid

#: Labelled rows of either label to fit on, at most; bounds of a prior's strength in documents; posterior at which a document is kept; weight of the site.
PER_CLASS, STRENGTHS, KEEP_AT, SITE_WEIGHT = 4000, (5.0, 500.0), 0.5, 1.0
#: Buckets of terms; labelled rows that a term's log odds are shrunk by; folds of rows that are weighed by the others' terms.
BUCKETS, SHRINK, FOLDS = 1 << 17, 4.0, 8
_MARKS = re.compile(r"[^\w\s.,;:'’\"()?-]")


def shape(text: str | None) -> list[float]:
    """Numbers that describe the form of a text, not its words."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    again = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    lines = [x for x in text.split("\n") if x]
    letters = sum(map(str.isalpha, text))
    marks = _MARKS.findall(text)
    return [
        math.log1p(n),
        chars / max(1, n),
        len(counts) / max(1, n) ** 0.8,
        top / max(1, n),
        again / max(1, n),
        sum(map(str.isupper, text)) / max(1, letters),
        letters / chars,
        len(marks) / max(1, n),
        text.count("|") / max(1, n),
        text.count("!") / max(1, n),
        (text.count(".") + text.count(",")) / max(1, n),
        len(set(lines)) / max(1, len(lines)),
        sum(map(str.isdigit, text)) / chars,
        n / max(1, len(lines)) / 100,
    ]


def terms(text: str | None) -> np.ndarray:
    """Distinct buckets of a text's words, A-Z and the like lower-cased."""
    return np.unique(np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in set((text or "").lower().split())), np.int64))


def term_odds(found: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log odds of label 1 by bucket against the share of all rows, shrunk to 0 where few rows have it."""
    good, bad = (np.bincount(np.concatenate([np.zeros(0, np.int64), *[t for t, z in zip(found, y, strict=True) if z == label]]), minlength=BUCKETS) for label in (1, 0))
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    return np.log((good + SHRINK * n1 / (n1 + n0)) / n1) - np.log((bad + SHRINK * n0 / (n1 + n0)) / n0)


def word_evidence(found: np.ndarray, odds: np.ndarray) -> list[float]:
    """Mean log odds of a text's terms, and the means of those above and below 0."""
    x = odds[found]
    n = max(1, len(x))
    return [float(x.sum()) / n, float(np.maximum(x, 0).sum()) / n, float(np.maximum(-x, 0).sum()) / n]


def _spread(x: np.ndarray) -> np.ndarray:
    """Each number of the shape, its square root and its square."""
    x = np.maximum(x, 0)
    return np.column_stack([x, np.sqrt(x), x * x])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 5) -> dict:
    """Model from at most PER_CLASS rows of either label whose crc32 of the id modulo held_out isn't 0, weighted to the labels' shares. With one label or no rows: a constant."""
    rest = remainder("doc_id", held_out) != 0
    picked = sample(labels, label, PER_CLASS, rest)
    shares = {r[0]: r[1] for r in labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & rest).groupBy(F.col(label).cast("int")).count().collect()}
    own = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("y", "text")  # 2 * PER_CLASS rows at most are broadcast

    def run(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shape(t) for t in texts], pa.list_(pa.float64())), pa.array([terms(t).astype(np.int32) for t in texts], pa.list_(pa.int32()))], ["y", "x", "terms"])

    rows = sorted((r["y"], tuple(r["x"]), tuple(r["terms"])) for r in own.mapInArrow(run, "y int, x array<double>, terms array<int>").collect())  # numbers of 2 * PER_CLASS rows at most
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        return {"constant": 4.0 if not len(y) or y[0] else -4.0}
    found = [np.array(r[2], np.int64) for r in rows]
    # A row's terms are weighed by what the other rows say: of every FOLDS rows one is left out of the odds it meets.
    words, fold = np.zeros((len(rows), 3)), np.arange(len(rows)) % FOLDS
    for f in range(FOLDS):
        odds = term_odds([t for t, k in zip(found, fold, strict=True) if k != f], y[fold != f])
        for k in np.flatnonzero(fold == f):
            words[k] = word_evidence(found[k], odds)
    x = np.column_stack([_spread(np.array([r[1] for r in rows])), words])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y > 0, shares[1] / max(1, (y > 0).sum()), shares[0] / max(1, (y <= 0).sum()))
    c = fit_logistic(np.clip((x - mean) / scale, -8, 8), y, weight * len(y) / weight.sum())
    return {"mean": mean, "scale": scale, "c": c, "odds": term_odds(found, y)}


def probabilities(texts: list[str | None], model: dict) -> np.ndarray:
    """The model's probability of label 1 for each text; null is as empty."""
    if "constant" in model or not texts:
        return sigmoid(np.full(len(texts), model.get("constant", 0.0)))
    x = np.column_stack([_spread(np.array([shape(t) for t in texts])), np.array([word_evidence(terms(t), model["odds"]) for t in texts])])
    return sigmoid(np.clip((x - model["mean"]) / model["scale"], -8, 8) @ model["c"][:-1] + model["c"][-1])


def evidence(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, host, path, p): the model's probability of each document; a null text is empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches):
        for b in batches:
            p = np.clip(probabilities([t.as_py() for t in b.column(4)], sent.value), 1e-4, 1 - 1e-4)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.round(p, 9))], ["doc_id", "text_hash", "host", "path", "p"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, text_hash long, host string, path string, p double")


def _strength(groups: DataFrame, mean: float, within: float) -> float:
    """Documents that a Beta prior is worth, from how far the means of groups (n, total) spread beyond chance."""
    off = F.col("n") * (F.col("total") / F.col("n") - mean) ** 2
    n, k, spread = groups.agg(F.sum("n"), F.count(F.lit(1)), F.sum(off)).first()
    between = max((spread - (k - 1) * within) / max(n, 1), 1e-9) if k and k > 1 else 1e-9
    return float(min(STRENGTHS[1], max(STRENGTHS[0], within / between)))


def posteriors(found: DataFrame, keep_at: float = KEEP_AT, site_weight: float = SITE_WEIGHT) -> DataFrame:
    """Rows of evidence with host_posterior, path_posterior, posterior and keep. Null hosts and paths are sites of their own.

    A column y, where there is one, holds the label of rows that have one to learn from: it counts for their sites instead of p.
    """
    known_as = F.coalesce(F.col("y").cast("double"), F.col("p")) if "y" in found.columns else F.col("p")
    found = found.withColumn("_s", known_as)
    total = found.agg(F.avg("_s"), F.var_pop("_s")).first()
    mean, within = total[0], total[1]
    if mean is None:
        mean, within = 0.5, 0.0
    within = max(within, 1e-6)
    paths = settle(found.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("_s").alias("total")))
    hosts = settle(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    sh = _strength(hosts, mean, within)
    sp = _strength(paths, mean, within)
    known = paths.alias("a").join(hosts.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host"))).select(F.col("a.host").alias("_host"), F.col("a.path").alias("_path"), F.col("a.n").alias("_n"), F.col("a.total").alias("_t"), F.col("b.n").alias("_hn"), F.col("b.total").alias("_ht"))
    out = found.join(settle(known), found.host.eqNullSafe(F.col("_host")) & found.path.eqNullSafe(F.col("_path")))
    host = (F.col("_ht") - F.col("_s") + sh * mean) / (F.col("_hn") - 1 + sh)
    out = out.withColumn("host_posterior", host)
    out = out.withColumn("path_posterior", (F.col("_t") - F.col("_s") + sp * F.col("host_posterior")) / (F.col("_n") - 1 + sp))
    logit = lambda c: F.log(c / (1 - c))
    odds = logit(F.col("p")) + site_weight * (logit(F.least(F.greatest("path_posterior", F.lit(1e-4)), F.lit(1 - 1e-4))) - logit(F.lit(float(min(max(mean, 1e-4), 1 - 1e-4)))))
    out = out.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("keep", F.col("posterior") >= keep_at)
    return out.drop("_host", "_path", "_n", "_t", "_hn", "_ht", "_s", "y")


def judged(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 5) -> DataFrame:
    """doc_id, text_hash, host, path, p, host_posterior, path_posterior, posterior, keep: one row for each row of docs, repeated ones too; empty docs give none.

    Labels of ids whose crc32 modulo held_out is 0 are learned neither by the classifier nor by the sites.
    """
    found = evidence(docs, train(docs, labels, label, held_out))
    own = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", held_out) != 0))
    own = own.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("y")).where("y in (0, 1)")
    return posteriors(settle(found.join(own, found["doc_id"] == own["_id"], "left").drop("_id")))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that are rejected; rows that repeat (id and text) go or stay together."""
    return without(docs, judged(docs, labels).where("not keep"))


def result(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels).drop("text_hash").withColumnRenamed("p", "evidence")
