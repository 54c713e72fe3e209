"""Near-duplicate detection: nearest neighbours, verification frame by frame, and which file of a pair goes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DUPLICATES
from ..functions import arrays as A
from ..functions import dsp
from ..functions.text import seconds_clock
from ..storage import settle
from .graph import components

#: Vectors of a block: two blocks meet in a task, as one matrix product.
BLOCK = 4096


def neighbours(df: DataFrame, key: str, vector: str, k: int = DUPLICATES.neighbours, block: int = BLOCK, unit: bool = True) -> DataFrame:
    """(i, j, sim, place): for each row the k rows of largest inner product, itself included; equal ones by key.

    Exact. Blocks of rows meet pairwise and hand on k candidates a row, so no task sees more than two blocks and no pair
    below the k best is written; the work grows with the square of the rows, as any exact search does.
    """
    own = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    blocks = max(1, -(-own.count() // block))
    own = own.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = own.withColumnRenamed("b", "p").withColumn("q", every)
    right = own.withColumnRenamed("b", "q").withColumn("p", every)

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"i": [], "j": [], "sim": []}).astype({"i": "int64", "j": "int64"})
        x, y = np.array(a["v"].tolist()), np.array(b["v"].tolist())
        if unit:
            x, y = (m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) > 0, n, 1) for m in (x, y))
        ids, order = b["id"].to_numpy(), np.argsort(b["id"].to_numpy(), kind="stable")
        ids, sims = ids[order], (x @ y.T)[:, order]
        top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        rows = np.arange(len(x))[:, None]
        return pd.DataFrame({"i": np.repeat(a["id"].to_numpy(), top.shape[1]), "j": ids[top].ravel(), "sim": sims[rows, top].ravel()})

    found = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(meet, "i long, j long, sim double")
    w = Window.partitionBy("i").orderBy(F.desc("sim"), F.asc("j"))
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def duration_ok(a: Column, b: Column, seconds: float = DUPLICATES.seconds) -> Column:
    """Both known: at most seconds apart. One known: no. Neither: yes."""
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) <= seconds).otherwise(a.isNull() & b.isNull())


def candidates(near: DataFrame, meta: DataFrame, key: str, source: str, duration: str | None = None, least: float = DUPLICATES.candidate) -> DataFrame:
    """Pairs i < j of neighbours that are similar enough, of different sources and compatible durations; meta has a row a key."""
    cols = [F.col(key), F.col(source).alias("src"), (F.col(duration) if duration else F.lit(None).cast("double")).alias("dur")]
    a = meta.select(*cols).toDF("i", "src_i", "dur_i")
    b = meta.select(*cols).toDF("j", "src_j", "dur_j")
    pairs = near.where((F.col("j") > F.col("i")) & (F.col("sim") >= least)).select("i", "j", "sim")
    return pairs.join(a, "i", "left").join(b, "j", "left").where((F.col("src_i") != F.col("src_j")) & duration_ok(F.col("dur_i"), F.col("dur_j"))).select("i", "j", "sim", "src_i", "src_j", "dur_i", "dur_j")


def verified(pairs: DataFrame, frames: DataFrame, key: str, vector: str, width: int, how=DUPLICATES) -> DataFrame:
    """Pairs with mean_sim, min_sim, p5_sim of their frames, similar, perfect and kind."""
    a = frames.select(F.col(key).alias("i"), F.col(vector).alias("_x"))
    b = frames.select(F.col(key).alias("j"), F.col(vector).alias("_y"))
    out = pairs.join(a, "i").join(b, "j").withColumn("_s", A.frame_stats("_x", "_y", width))
    out = out.withColumns({"mean_sim": F.col("_s.mean"), "min_sim": F.col("_s.least"), "p5_sim": F.col("_s.low")})
    similar = (F.col("mean_sim") >= how.mean) & (F.col("min_sim") >= how.least) & (F.col("p5_sim") >= how.low)
    perfect = A.close_vectors("_x", "_y") | (F.col("mean_sim") >= how.perfect)
    return out.withColumns({"similar": similar, "perfect": perfect}).withColumn("kind", F.when(F.col("perfect"), "perfect").when(F.col("similar"), "near")).drop("_s", "_x", "_y")


def embeddings(waves: DataFrame, key: str, samples: str = "samples", rate: int = dsp.RATE) -> DataFrame:
    """(key, descriptor, frames): pooled descriptor and unit log-mel frames, frame after frame; nulls below 3 s."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ys = [np.asarray(y.as_py() or [], np.float32) for y in b.column(1)]
            f = [dsp.frame_embedding(y, rate) for y in ys]
            d = [None if m is None else dsp.pooled(m).tolist() for m in f]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(d, pa.list_(pa.float32())), pa.array([None if m is None else m.T.ravel().astype(np.float32) for m in f], pa.list_(pa.float32()))], [key, "descriptor", "frames"])

    kind = waves.schema[key].dataType.simpleString()
    return waves.select(key, samples).mapInArrow(run, f"{key} {kind}, descriptor array<float>, frames array<float>")


def with_keep_rule(pairs: DataFrame, i: str = "xc_i", j: str = "xc_j", rec_i: str = "rec_i", rec_j: str = "rec_j", sim: str | None = None) -> DataFrame:
    """pairs with same_recordist, removed, kept, removes (i or j) and reason.

    Same recordist (blank on both sides counts as same): the lower number goes. Different: the higher goes, as a
    copied upload. Equal numbers: the first file goes.
    """
    a, b = F.coalesce(F.trim(rec_i), F.lit("")), F.coalesce(F.trim(rec_j), F.lit(""))
    same = a == b
    second = F.when(same, F.col(i) > F.col(j)).otherwise(F.col(i) < F.col(j))
    out = pairs.withColumn("same_recordist", same).withColumn("rec_unknown", same & (a == "")).withColumn("removes", F.when(second, "j").otherwise("i"))
    out = out.withColumn("removed", F.when(second, F.col(j)).otherwise(F.col(i))).withColumn("kept", F.when(second, F.col(i)).otherwise(F.col(j)))
    lead = F.format_string("near duplicate (%.4f); ", F.col(sim)) if sim else F.lit("")
    text = F.when(same, F.format_string("one recordist (%s): newer XC%s kept, older XC%s removed", a, F.col("kept").cast("string"), F.col("removed").cast("string")))
    text = text.otherwise(F.format_string("recordists differ ('%s', '%s'): older XC%s kept, newer XC%s removed", a, b, F.col("kept").cast("string"), F.col("removed").cast("string")))
    return out.withColumn("reason", F.concat(lead, text))


#: Pairs of a component that one task resolves.
COMPONENT = 100_000


def resolved(pairs: DataFrame, order: list[str], file_i: str, file_j: str, removes: str = "removes", max_rounds: int = 10_000, at_once: int = COMPONENT) -> DataFrame:
    """pairs with taken: whether the pair removed its file when pairs are handled one by one in order, those of a removed file being skipped.

    Pairs bear on one another only within a component of files. Components of up to at_once pairs are handled one by one,
    each in a task, as narrow rows (all pairs in one, if they are no more); larger ones in rounds, in which none meets in
    a task. order must be total. A null file
    is no file: it is never removed.
    """
    name = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c)))
    gone = F.when(F.col(removes) == "j", F.col(file_j)).otherwise(F.col(file_i))
    own = settle(pairs.withColumns({"_o": F.struct(*order), "_gone": gone, "_a": name(file_i), "_b": name(file_j)}))
    if own.count() <= at_once:  # one task can handle them all
        own = own.withColumns({"_root": F.lit(0).cast("long"), "_n": F.lit(0).cast("long")}).drop("_a", "_b")
    else:
        roots = components(own.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
        node = F.coalesce("_a", "_b", F.xxhash64("_o"))
        own = own.withColumn("_node", node).join(roots, F.col("_node") == F.col("node"), "left").withColumn("_root", F.coalesce("root", "_node")).drop("_a", "_b", "_node", "node", "root")
        sizes = own.groupBy(F.col("_root").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
        own = settle(own.join(sizes, F.col("_root") == F.col("_of")).drop("_of"))
    few, many = own.where(F.col("_n") <= at_once).drop("_n"), own.where(F.col("_n") > at_once).drop("_n", "_root")
    few = few.withColumn("_k", F.row_number().over(Window.partitionBy("_root").orderBy("_o")))

    def handle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, removed, taken = pdf.sort_values("k"), set(), []
        for i, j, g in zip(pdf["i"], pdf["j"], pdf["g"], strict=True):
            taken.append(i not in removed and j not in removed)
            if taken[-1] and not pd.isna(g):
                removed.add(g)
        return pdf[["r", "k"]].assign(taken=taken)

    text = lambda c, to: F.col(c).cast("string").alias(to)
    said = few.select(F.col("_root").alias("r"), F.col("_k").alias("k"), text(file_i, "i"), text(file_j, "j"), text("_gone", "g")).groupBy("r").applyInPandas(handle, "r long, k int, taken boolean")
    few = few.join(said, (F.col("_root") == F.col("r")) & (F.col("_k") == F.col("k"))).drop("_root", "_k", "r", "k", "_o", "_gone")
    return few if many.isEmpty() else few.unionByName(_in_rounds(many, file_i, file_j, max_rounds))


def _in_rounds(own: DataFrame, file_i: str, file_j: str, max_rounds: int) -> DataFrame:
    """resolved() for pairs with their order _o and the file _gone that they would remove: a pair is settled as soon as no earlier open pair could remove one of its files. As many rounds as the longest chain of removals that wait for one another."""
    left, done = own, []
    for _ in range(max_rounds):
        if left.isEmpty():
            break
        threat = left.groupBy("_gone").agg(F.min("_o").alias("_m"))
        a, b = threat.toDF("_fi", "_mi"), threat.toDF("_fj", "_mj")
        seen = left.join(a, left[file_i] == F.col("_fi"), "left").join(b, left[file_j] == F.col("_fj"), "left")
        free = (F.col("_mi").isNull() | (F.col("_o") <= F.col("_mi"))) & (F.col("_mj").isNull() | (F.col("_o") <= F.col("_mj")))
        seen = settle(seen.withColumn("_free", free).drop("_fi", "_fj", "_mi", "_mj"))
        taken, rest = seen.where("_free").drop("_free"), seen.where("not _free").drop("_free")
        done.append(taken.withColumn("taken", F.lit(True)))
        gone = taken.select(F.col("_gone").alias("_g"), F.col("_o").alias("_at"))  # a file goes once
        i, j = gone.toDF("_gi", "_ai"), gone.toDF("_gj", "_aj")
        late = rest.join(i, rest[file_i] == F.col("_gi"), "left").join(j, rest[file_j] == F.col("_gj"), "left")
        skip = F.coalesce(F.col("_ai") < F.col("_o"), F.lit(False)) | F.coalesce(F.col("_aj") < F.col("_o"), F.lit(False))
        late = settle(late.withColumn("_skip", skip).drop("_gi", "_ai", "_gj", "_aj"))
        done.append(late.where("_skip").drop("_skip").withColumn("taken", F.lit(False)))
        left = late.where("not _skip").drop("_skip")
    else:
        raise RuntimeError(f"pairs not settled after {max_rounds} rounds")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("_o", "_gone")


def differences(pairs: DataFrame, meta: DataFrame, key: str, rate: str = "smp", length: str = "length") -> DataFrame:
    """pairs (i, j) with both sample rates, whether they match (null where one is unknown), and both durations (0 where unknown)."""
    own = meta.select(F.col(key), F.col(rate).try_cast("int").alias("sr"), F.coalesce(seconds_clock(length), F.lit(0.0)).alias("s"))
    out = pairs.join(own.toDF("i", "sr_i", "seconds_i"), "i", "left").join(own.toDF("j", "sr_j", "seconds_j"), "j", "left").na.fill(0.0, ["seconds_i", "seconds_j"])
    return out.withColumn("sample_rate_match", F.col("sr_i") == F.col("sr_j"))


def exact_groups(df: DataFrame, text: str, key: str) -> DataFrame:
    """(digest, n, first): groups of equal texts of two or more."""
    return df.where(F.col(text).isNotNull()).groupBy(F.md5(text).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).where("n > 1")


def report(pairs: DataFrame) -> DataFrame:
    """Lines of the duplicate report, a row a pair."""
    return pairs.select(F.concat_ws(" | ", F.col("kind"), F.col("removed").cast("string"), F.col("kept").cast("string"), F.col("reason")).alias("line"))


def totals(pairs: DataFrame) -> DataFrame:
    """Pairs, those of each kind, those that removed a file, files removed, and pairs of one recordist."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    gone = F.count_distinct(F.when(F.col("taken"), F.col("removed")))
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), n(F.col("kind") == "perfect").alias("perfect"), n(F.col("kind") == "near").alias("near"), n(F.col("taken")).alias("resolved"), gone.alias("files_removed"), n(F.col("same_recordist")).alias("same_recordist"))
