"""Choice of segments by energy: over samples held as rows, and over waveforms held as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AUDIO
from ..functions import dsp


def row_windows(df: DataFrame, record: str, order: list[str], value: str, window: int, hop: int, partial: bool = True) -> DataFrame:
    """(record, start, rms, n): windows of window rows every hop rows of each record, in a total order; start counts from 0.

    A record shorter than a window is one partial window (or none without partial).
    """
    w = Window.partitionBy(record).orderBy(*order)
    all_rows = Window.partitionBy(record)
    energy = F.sum(F.col(value) * F.col(value)).over(w.rowsBetween(0, window - 1))
    rows = df.select(record, F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(all_rows).alias("_size"), energy.alias("_e"), F.count(F.lit(1)).over(w.rowsBetween(0, window - 1)).alias("n"))
    full = (F.col("n") == window) & ((F.col("_rn") - 1) % hop == 0)
    short = (F.col("_size") < window) & (F.col("_rn") == 1)
    return rows.where(full | short if partial else full).select(record, (F.col("_rn") - 1).cast("long").alias("start"), F.sqrt(F.col("_e") / F.col("n")).alias("rms"), F.col("n").cast("long").alias("n"))


def loudest(windows: DataFrame, record: str, latest: bool = False) -> DataFrame:
    """The loudest window of each record, the earliest of equal ones, or the latest."""
    w = Window.partitionBy(record).orderBy(F.desc("rms"), F.desc("start") if latest else F.asc("start"))
    return windows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def above_or_best(windows: DataFrame, record: str, threshold: float, count: int = 1) -> DataFrame:
    """Up to count windows of each record: those at threshold first, then the loudest of the rest; with fallback, and in order of start."""
    quiet = F.col("rms") < threshold
    w = Window.partitionBy(record).orderBy(quiet, F.desc("rms"), F.asc("start"))
    return windows.withColumn("fallback", quiet).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= count).drop("_rn")


def away_from(windows: DataFrame, used: DataFrame, record: str, apart: float) -> DataFrame:
    """Windows that start at least apart from every used start (record, used) of their record. A null start is no start.

    The starts are put in buckets apart wide, so that a window meets those of three buckets and not all of its record.
    """
    bucket = lambda c: F.floor(c / apart)
    near = used.where("used is not null").select(F.col(record).alias("_r"), F.col("used").alias("_u"), F.explode(F.array(bucket(F.col("used")) - 1, bucket(F.col("used")), bucket(F.col("used")) + 1)).alias("_b"))
    return windows.join(near, (windows[record] == F.col("_r")) & (bucket(windows["start"]) == F.col("_b")) & (F.abs(windows["start"] - F.col("_u")) < apart), "left_anti")


def replacement(windows: DataFrame, used: DataFrame, record: str, apart: float, threshold: float) -> DataFrame:
    """The loudest window away from used starts, the latest of equal ones. Only where a record has no window at threshold do quieter ones count."""
    loud = F.max((F.col("rms") >= threshold).cast("int")).over(Window.partitionBy(record))
    fit = windows.withColumn("_loud", loud).where((F.col("rms") >= threshold) | (F.col("_loud") == 0)).drop("_loud")
    return loudest(away_from(fit, used, record, apart), record, latest=True)


def separated(windows: DataFrame, record: str, count: int, apart: int, threshold: float | None = None) -> DataFrame:
    """Up to count windows of each record, loudest first, each at least apart from those taken. Sequential by nature; a record's windows meet in one task."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        at = dsp.separated(pdf["start"].to_numpy(), pdf["rms"].to_numpy(), count, apart, threshold)
        return pdf.iloc[at].assign(place=range(1, len(at) + 1))

    schema = T.StructType([*windows.schema.fields, T.StructField("place", T.LongType())])
    return windows.groupBy(record).applyInPandas(pick, schema)


def array_windows(samples: Column | str, window: int = AUDIO.window, hop: int = AUDIO.hop) -> Column:
    """Array of (start, rms) of a waveform's sliding windows, as an Arrow function."""

    @F.pandas_udf("array<struct<start:bigint,rms:double>>")
    def run(ys: pd.Series) -> pd.Series:
        return ys.map(lambda y: [{"start": int(s), "rms": float(r)} for s, r in zip(*dsp.window_rms(np.asarray(y, np.float32), window, hop), strict=True)] if y is not None else None)

    return run(samples)


@F.udtf(returnType="start: bigint, rms: double")
class Windows:
    """Table function: windows(samples, window, hop)."""

    def eval(self, samples, window: int, hop: int):
        for s, r in zip(*dsp.window_rms(np.asarray(samples or [], np.float32), window, hop), strict=True):
            yield int(s), float(r)


CLIP = "onset_ms long, rms_energy double, samples array<float>, status string, reason string"


def _mapped(df: DataFrame, drop: list[str], added: str, work) -> DataFrame:
    """mapInArrow over whole rows: work turns a row into a dict of the added columns, or several in a list."""
    extra = T.StructType.fromDDL(added)
    names = [f.name for f in extra.fields]
    kept = [c for c in df.columns if c not in drop and c not in names]
    schema = T.StructType([*df.select(*kept).schema.fields, *extra.fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                got = work(row)
                for one in got if isinstance(got, list) else [got]:
                    out.append({c: row[c] for c in kept} | one)
            yield pa.RecordBatch.from_pylist(out, arrow)

    return df.mapInArrow(run, schema)


def decoded(files: DataFrame, content: str = "content", rate: int = AUDIO.rate) -> DataFrame:
    """files without content, with samples (null where undecodable), seconds and reason."""

    def work(row: dict) -> dict:
        try:
            y = dsp.load(row[content], rate)
            return {"samples": y.tolist(), "seconds": len(y) / rate, "reason": None}
        except Exception as e:  # a file that can't be read is a row with a reason, never a failed task
            return {"samples": None, "seconds": None, "reason": f"decode: {type(e).__name__}"}

    return _mapped(files, [content], "samples array<float>, seconds double, reason string", work)


def positive_clips(waves: DataFrame, samples: str = "samples", count: int = 1, audio=AUDIO, limit: bool = True, allow_short: bool = False) -> DataFrame:
    """Clips of the loudest windows of each wave: those at the least energy first, apart from each other, then the loudest of any; in order of start.

    Waves shorter than a window give one row with a reason (one short clip with allow_short, if loud enough). Clipped
    waves are scaled and limited.
    """

    def work(row: dict):
        y = np.asarray(row[samples] if row[samples] is not None else [], np.float32)
        if len(y) < audio.window and not (allow_short and len(y)):
            return {"onset_ms": None, "rms_energy": None, "samples": None, "status": "skip", "reason": "too_short"}
        starts, rms = dsp.window_rms(y, audio.window, audio.hop)
        apart = int(round(audio.separation_s * audio.rate))
        got = dsp.separated(starts, rms, count, apart, audio.min_rms)
        if len(y) < audio.window and not got:
            return {"onset_ms": None, "rms_energy": None, "samples": None, "status": "skip", "reason": "too_short"}
        for k in dsp.separated(starts, rms, count, apart):
            if len(got) < count and k not in got:
                got.append(k)
        out = []
        for k in sorted(got, key=lambda k: starts[k]):
            clip = y[starts[k] : starts[k] + audio.window]
            if limit and np.abs(clip).max(initial=0) >= 0.9999:
                clip = dsp.soft_limit(clip)
            out.append({"onset_ms": int(round(1000 * int(starts[k]) / audio.rate)), "rms_energy": float(rms[k]), "samples": clip.tolist(), "status": "ok", "reason": None})
        return out

    return _mapped(waves, [samples], CLIP, work)


def negative_clips(waves: DataFrame, samples: str = "samples", pad: bool = False, audio=AUDIO) -> DataFrame:
    """The loudest window of each wave, or why there is none; with pad, shorter waves are filled with zeros and is_short."""

    def work(row: dict) -> dict:
        y = np.asarray(row[samples] if row[samples] is not None else [], np.float32)
        if pad:
            clip, at, short = dsp.loudest_or_pad(y, audio.window, audio.hop)
            why = None if clip is not None else "all_zero" if len(y) else "too_short"
        else:
            at, why = dsp.loudest(y, audio.window, audio.hop)
            clip, short = (None, False) if why else (y[at : at + audio.window], False)
        return {
            "onset_ms": None if clip is None else int(round(1000 * at / audio.rate)),
            "rms_energy": None if clip is None else float(np.sqrt(np.mean(np.square(clip, dtype=np.float64)))),
            "samples": None if clip is None else clip.tolist(),
            "status": "ok" if clip is not None else "skip",
            "reason": why,
            "is_short": short,
        }

    return _mapped(waves, [samples], CLIP + ", is_short boolean", work)


def clip_at(waves: DataFrame, onset: str, samples: str = "samples", audio=AUDIO) -> DataFrame:
    """The window at an onset in milliseconds, filled with zeros at the end, limited where it clips."""

    def work(row: dict) -> dict:
        y = np.asarray(row[samples] if row[samples] is not None else [], np.float32)
        at = int(max(0, row[onset] or 0)) * audio.rate // 1000
        clip = y[at : at + audio.window]
        clip = dsp.curve_limit(np.pad(clip, (0, audio.window - len(clip))))
        return {"clip": clip.tolist()}

    return _mapped(waves, [samples], "clip array<float>", work)


def features(waves: DataFrame, samples: str = "samples", kind: str = "embedding", rate: int = AUDIO.rate) -> DataFrame:
    """waves without samples, with salience and embedding, or, as kind cnn, the 224 x 224 picture; null where a wave is missing."""

    def work(row: dict) -> dict:
        if row[samples] is None:
            return {"salience": 0.0, "embedding": None} if kind == "embedding" else {"picture": None}
        y = np.asarray(row[samples], np.float32)
        if kind == "cnn":
            return {"picture": dsp.cnn_features(y, rate).ravel().tolist()}
        return {"salience": dsp.salience(y, rate), "embedding": dsp.clip_embedding(y, rate).tolist()}

    return _mapped(waves, [samples], "salience double, embedding array<float>" if kind == "embedding" else "picture array<float>", work)
