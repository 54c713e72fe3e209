"""Writing intermediate tables where every executor can read them, and ranks over whole tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset a folder of our own, in local mode only: other machines couldn't read it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = os.path.join(tempfile.gettempdir(), "mediasieve-shared")
        os.makedirs(own, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", found := f"file://{own}")
    return found


def settle(df: DataFrame) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: its lineage is cut, a lost executor costs nothing, and it is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/mediasieve-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables as settle gave them, once no result reads them any more."""
    for t in tables:
        context = t.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if not folder.rpartition("/")[2].startswith("mediasieve-"):
                raise ValueError(f"{folder} was not written by settle")
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Shuffles go when the action that made them ends, not when the driver next collects garbage.
_SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile leaves less on disk. Lazy results that may run more than once belong outside: their shuffles would be made anew each time."""
    before = {k: spark.conf.get(k, None) for k in _SPARING}
    for k, v in _SPARING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ranked(df: DataFrame, *order: Column | str, name: str = "rank", start: int = 1) -> DataFrame:
    """df with its rank in a total order, without a task that gets all rows.

    Rows are dealt out by range, numbered in their partition, and moved on by the sizes of the partitions before (one
    number a partition comes to the driver). Ties take any order; end order with a unique column to fix it.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    own = settle(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = {r[0]: r[1] for r in own.groupBy("_p").count().collect()}
    ahead, at = [], start - 1
    for p in sorted(sizes):
        ahead.append((p, at))
        at += sizes[p]
    before = df.sparkSession.createDataFrame(ahead or [(-1, 0)], "_p int, _ahead long")
    numbered = own.withColumn(name, F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return numbered.join(before, "_p").withColumn(name, F.col(name) + F.col("_ahead")).drop("_p", "_ahead")


def ranked_within(df: DataFrame, group: str, *order: Column | str, name: str = "rank", size: str | None = None) -> DataFrame:
    """df with its rank within each group, from 1, and the group's size if wanted: ranks of the whole order, less where a group begins, so that a group of any size is spread over tasks."""
    own = settle(ranked(df, F.col(group), *order, name=name))
    begins = own.groupBy(F.col(group).alias("_of")).agg((F.min(name) - 1).alias("_lo"), F.count(F.lit(1)).alias("_size_of"))
    out = own.join(begins, F.col(group).eqNullSafe(F.col("_of"))).withColumn(name, F.col(name) - F.col("_lo"))
    return (out.withColumn(size, F.col("_size_of")) if size else out).drop("_of", "_lo", "_size_of")


#: Rows that one task may sort and hand on.
FEW = 100_000


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in a total order: few by a limit, many by ranks that no single task computes."""
    if n <= FEW:
        return df.orderBy(*order).limit(max(0, n))
    return ranked(df, *order, name="_place").where(F.col("_place") <= n).drop("_place")


def running(df: DataFrame, order: list[Column | str], sums: dict[str, str]) -> DataFrame:
    """df with running sums of columns in a total order, {new name: column}; no task gets all rows. Only sums of partitions come to the driver."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    own = settle(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    totals = {r["_p"]: r for r in own.groupBy("_p").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()}
    ahead, at = [], dict.fromkeys(sums, 0)
    for p in sorted(totals):
        ahead.append((p, *[float(at[n]) for n in sums]))
        at = {n: at[n] + (totals[p][n] or 0) for n in sums}
    names = ", ".join(f"_a_{n} double" for n in sums)
    before = df.sparkSession.createDataFrame(ahead or [(-1, *[0.0] * len(sums))], f"_p int, {names}")
    w = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = own.withColumns({n: F.sum(c).over(w) for n, c in sums.items()}).join(before, "_p")
    return out.withColumns({n: F.col(n) + F.col(f"_a_{n}") for n in sums}).drop("_p", *[f"_a_{n}" for n in sums])
