"""Writers. Operators return DataFrames; these are what a caller may write them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dsp, flac


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """A log that grows, as Parquet."""
    df.write.mode("append").parquet(path)


def write_by_status(df: DataFrame, path: str, status: str = "status") -> None:
    """One folder a status, in one write: moves between folders become a column."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet table that df itself reads: written beside it, then swapped by renaming."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old, now = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    fs = now.getFileSystem(conf)
    fs.delete(old, True)
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)


def with_wav(clips: DataFrame, samples: str = "samples", rate: int = dsp.RATE) -> DataFrame:
    """clips with content, the samples as a 16-bit wav; null where there are none."""

    @F.pandas_udf("binary")
    def encode(ys):
        import numpy as np

        return ys.map(lambda y: None if y is None else dsp.write_wav(np.asarray(y, np.float32), rate))

    return clips.withColumn("content", encode(samples))


def with_flac(clips: DataFrame, samples: str = "samples", rate: int = dsp.RATE) -> DataFrame:
    """clips with content, the samples as a mono 16-bit FLAC file; null where there are none."""

    @F.pandas_udf("binary")
    def encode(ys):
        import numpy as np

        return ys.map(lambda y: None if y is None else flac.write(np.asarray(y, np.float32), rate))

    return clips.withColumn("content", encode(samples))


def write_files(df: DataFrame, put: Callable[[str, bytes], None], name: str = "name", content: str = "content") -> None:
    """Hands each file to put, in the tasks. put must bear being called again for a name, as tasks may be tried again."""

    def each(rows) -> None:
        for r in rows:
            if r[content] is not None:
                put(r[name], bytes(r[content]))

    df.select(name, content).foreachPartition(each)


def report_text(title: str, sections: dict[str, DataFrame], rows: int = 20) -> str:
    """A text report; each section shows rows of its table at most, which should be an aggregate."""
    out = [title, "=" * len(title)]
    for name, df in sections.items():
        out += ["", name, "  ".join(df.columns)]
        out += ["  ".join("" if v is None else str(v) for v in r) for r in df.limit(rows).collect()]
    return "\n".join(out) + "\n"
