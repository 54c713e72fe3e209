"""Applying manual corrections to a table of clips, and summing them up."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AUDIO
from ..functions import text as X
from .hygiene import keep_last


def upsert(old: DataFrame, new: DataFrame, key: str = "clip_filename") -> DataFrame:
    """Corrections with those of new in place of older ones for the same clip; onsets of no_bird are blank."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    out = keep_last(both, [key], ["_age"]).drop("_age")
    return out.withColumn("corrected_onset_ms", F.when(F.col("issue_type") == "no_bird", "").otherwise(F.col("corrected_onset_ms")))


def prepared(rows: DataFrame) -> DataFrame:
    """Corrections with parts of the file name, the resolved issue and the onset as a number."""
    parts = X.clip_parts(F.trim("clip_filename"))
    out = rows.withColumn("clip_filename", F.trim("clip_filename")).withColumn("_p", parts)
    return out.withColumns({"issue": X.resolved_issue("issue_type", "corrected_onset_ms"), "id": F.col("_p.id"), "grade": F.col("_p.grade"), "onset_ms": F.col("_p.onset_ms"), "new_onset_ms": F.trim("corrected_onset_ms").try_cast("long")}).drop("_p")


LOG = "id string, clip_filename string, issue_type string, result string, new_filename string, notes string, seq long"


def applied(rows: DataFrame, onsets: DataFrame, windows: DataFrame, order: str, apart_ms: float = 1500, least: float = AUDIO.min_rms) -> DataFrame:
    """The action log of corrections (clip_filename, issue_type, corrected_onset_ms, order) handled in order.

    onsets (id, onset_ms): clips in the set; windows (id, grade, start_ms, rms): candidates of each source. State is that
    of one recording: its onsets change as rows are handled, so the rows of a recording meet in one task, and only they;
    its windows meet them there once. Rows whose file name doesn't fit have no recording: they are errors, and meet nowhere.
    results: corrected, replaced, removed_no_replacement, skipped, error.
    """
    own = prepared(rows).withColumn("seq", F.col(order).cast("long")).withColumn("id", F.coalesce("id", F.lit("")))
    corrections = own.select("id", "clip_filename", F.lower(F.trim("issue_type")).alias("issue_type"), "issue", "grade", "onset_ms", "new_onset_ms", "seq")
    unfit = corrections.where("id = ''").select("id", "clip_filename", "issue_type", F.lit("error").alias("result"), F.lit("").alias("new_filename"), F.lit("file name doesn't fit").alias("notes"), "seq")
    corrections = corrections.where("id <> ''")
    none = lambda kind: F.lit(None).cast(kind)
    known = windows.select("id", "grade", F.col("start_ms").cast("long").alias("start_ms"), F.col("rms").cast("double").alias("rms"), none("long").alias("used"))
    known = known.union(onsets.select("id", none("string"), none("long"), none("double"), F.col("onset_ms").cast("long")))
    known = known.join(corrections.select("id").distinct(), "id", "left_semi")

    def run(pdf: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable")
        have = sorted(int(x) for x in around["used"].dropna())
        sounds = around[around["start_ms"].notna()]
        out = []
        for r in pdf.itertuples():
            done, new, note = "", "", ""
            if r.issue == "wrong_onset":
                if pd.isna(r.new_onset_ms):
                    done, note = "skipped", "missing corrected_onset_ms"
                elif not (sounds["grade"] == r.grade).any():
                    done, note = "error", "no source"
                else:
                    done, at = "corrected", int(r.new_onset_ms)
            elif r.issue == "no_bird":
                mine = sounds[sounds["grade"] == r.grade]
                start, rms = mine["start_ms"].to_numpy(np.int64), mine["rms"].to_numpy(float)
                fit = rms >= least if (rms >= least).any() else np.ones(len(rms), bool)
                others = [o for o in have if o != r.onset_ms]
                order = [k for k in np.lexsort((-start, -rms)) if fit[k] and all(abs(start[k] - o) >= apart_ms for o in others)]
                done, at = ("replaced", int(start[order[0]])) if order else ("removed_no_replacement", None)
                if at is None and r.onset_ms in have:
                    have.remove(r.onset_ms)
            else:
                done, note = "skipped", f"unknown issue_type: {r.issue_type}"
            if done in ("corrected", "replaced"):
                if r.onset_ms in have:
                    have.remove(r.onset_ms)
                have.append(at)
                new = f"xc{r.id}_{r.grade}_{at}.wav"
            out.append((r.id, r.clip_filename, r.issue_type, done, new, note, r.seq))
        return pd.DataFrame(out, columns=[c.split()[0] for c in LOG.split(", ")])

    return corrections.groupBy("id").cogroup(known.groupBy("id")).applyInPandas(run, LOG).union(unfit)


def corrected_clips(clips: DataFrame, log: DataFrame, name: str = "clip_filename") -> DataFrame:
    """Names of clips after the log: removed and renamed ones gone, new ones in."""
    gone = log.where(F.col("result").isin("corrected", "replaced", "removed_no_replacement")).select(F.col("clip_filename").alias("_g")).distinct()
    new = log.where("new_filename <> ''").select(F.col("new_filename").alias(name)).distinct()
    return clips.select(name).join(gone, F.col(name) == F.col("_g"), "left_anti").union(new).distinct()


def summary(log: DataFrame) -> DataFrame:
    """Counts by outcome and the net change in clips; net_change_compat counts replacements as gains, as the old report did."""
    n = lambda r: F.count_if(F.col("result") == r)
    return log.agg(n("corrected").alias("corrected"), n("replaced").alias("replaced"), n("removed_no_replacement").alias("not_replaced"), n("skipped").alias("skipped"), n("error").alias("errors"), (-n("removed_no_replacement")).alias("net_change"), (n("replaced") - n("removed_no_replacement")).alias("net_change_compat"))


def source_windows(waves: DataFrame, key: str = "id", grade: str = "grade", samples: str = "samples", audio=AUDIO) -> DataFrame:
    """(id, grade, start_ms, rms) of every window of every source wave, for applied()."""
    from .segments import array_windows

    w = waves.select(F.col(key).cast("string").alias("id"), F.col(grade).alias("grade"), F.explode(array_windows(F.col(samples), audio.window, audio.hop)).alias("w"))
    return w.select("id", "grade", X.onset_ms_floor("w.start", audio.rate).alias("start_ms"), F.col("w.rms").alias("rms"))


__all__ = ["applied", "corrected_clips", "prepared", "source_windows", "summary", "upsert"]
