"""Classification metrics over (label, score) tables, from sums over distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import running

THRESHOLDS = 100


def confusion(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """tp, fp, fn, tn with the score rounded half to even."""
    p, y = F.bround(score, 0) >= 1, F.col(label) == 1
    return df.dropna(subset=[label, score]).agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def prf1(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """accuracy, precision, recall, f1; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, label, score).select(_ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """A row for each distinct score, the highest first: (score, pos, neg, tp, fp) with running counts."""
    sums = df.dropna(subset=[label, score]).groupBy(F.col(score).cast("double").alias("score")).agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))
    return running(sums, [F.desc("score")], {"tp": "pos", "fp": "neg"})


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve; ties count half, and one class alone gives null."""
    c = curve(df, label, score)
    s = c.agg(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)).alias("a"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return s.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("a") / (F.col("p") * F.col("n"))).alias("auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c = curve(df, label, score)
    s = c.agg(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("a"), F.sum("pos").alias("p"))
    return s.select(F.when(F.col("p") > 0, F.col("a") / F.col("p")).alias("average_precision"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c = curve(df, label, score)
    t = c.agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return c.crossJoin(F.broadcast(t)).select("score", (F.col("fp") / F.col("_n")).alias("fpr"), (F.col("tp") / F.col("_p")).alias("tpr"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    c = curve(df, label, score)
    t = c.agg(F.sum("pos").alias("_p"))
    return c.crossJoin(F.broadcast(t)).select("score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("_p")).alias("recall"))


def f1_sweep(df: DataFrame, label: str = "label", score: str = "score", n: int = THRESHOLDS) -> DataFrame:
    """(threshold, f1) for n even thresholds of [0, 1]. Rows fall into n + 1 bins first, so each is read once."""
    own = df.dropna(subset=[label, score])
    grid = F.array(*[F.lit(k / (n - 1)) for k in range(n)])
    bins = own.groupBy(F.size(F.filter(grid, lambda t: t <= F.col(score))).alias("b")).agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.count(F.lit(1)).alias("m"))
    every = df.sparkSession.range(n + 1).select(F.col("id").cast("int").alias("b")).join(bins, "b", "left").na.fill(0)
    down = Window.orderBy(F.desc("b"))  # n + 1 rows
    sums = every.withColumn("tp", F.sum("p").over(down)).withColumn("said", F.sum("m").over(down)).withColumn("pos", F.sum("p").over(Window.partitionBy(F.lit(1))))
    return sums.where("b >= 1").select(((F.col("b") - 1) / (n - 1)).alias("threshold"), _ratio(2.0 * F.col("tp"), (F.col("said") + F.col("pos")).cast("double")).alias("f1"))


def best_threshold(df: DataFrame, label: str = "label", score: str = "score", n: int = THRESHOLDS) -> DataFrame:
    """The first threshold of the best F1."""
    return f1_sweep(df, label, score, n).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def across_runs(df: DataFrame, model: str, *values: str) -> DataFrame:
    """Mean and deviation of metrics over runs of a model."""
    return df.groupBy(model).agg(*[f(v).alias(f"{v}_{n}") for v in values for f, n in ((F.avg, "mean"), (F.stddev, "std"))])


def both_classes(df: DataFrame, label: str = "label") -> bool:
    n, least, most = df.agg(F.count_distinct(label), F.min(label), F.max(label)).first()
    return n >= 2
