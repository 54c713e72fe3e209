"""Column functions over waveforms and descriptors held as arrays, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda s, x: s + x)


def rms(c: Column | str) -> Column:
    """Root mean square; 0 for an empty array."""
    y = _col(c)
    return F.when(F.size(y) > 0, F.sqrt(total(F.transform(y, lambda v: v.cast("double") * v.cast("double"))) / F.size(y))).otherwise(0.0)


def peak(c: Column | str) -> Column:
    return F.coalesce(F.array_max(F.transform(_col(c), F.abs)).cast("double"), F.lit(0.0))


def clipped(c: Column | str, at: float = 0.9999) -> Column:
    return F.exists(_col(c), lambda v: F.abs(v) >= at)


def all_zero(c: Column | str) -> Column:
    return F.forall(_col(c), lambda v: v == 0)


def soft_limit(c: Column | str, ceiling: float = 0.99, alpha: float = 5.0) -> Column:
    """Scaled to a peak of ceiling at most, then tanh(alpha y) / alpha; silence stays."""
    y, top = _col(c), peak(c)
    scale = F.when(top > ceiling, F.lit(ceiling) / top).otherwise(1.0)
    return F.when(top == 0, y.cast("array<double>")).otherwise(F.transform(y, lambda v: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.tanh(v.cast("double") * scale * alpha) / alpha))))


def curve_limit(c: Column | str, ceiling: float = 0.99, alpha: float = 5.0, at: float = 0.9999) -> Column:
    """Only where the peak reaches at: scaled to ceiling, then y (1 + alpha) / (1 + alpha |y|)."""
    y, top = _col(c), peak(c)
    limited = F.transform(y, lambda v: v / top * ceiling * (1 + alpha) / (1 + alpha * F.abs(v / top * ceiling)))
    return F.when(top >= at, limited).otherwise(y.cast("array<double>"))


def fitted(c: Column | str, n: int) -> Column:
    """Exactly n elements: cut off, or filled with zeros."""
    y = _col(c)
    return F.concat(F.slice(y, 1, n), F.array_repeat(F.lit(0).cast("double"), F.greatest(F.lit(0), F.lit(n) - F.size(y))))


def repeated(c: Column | str, n: int) -> Column:
    """Exactly n elements, the array repeated as often as needed; zeros for an empty one."""
    y = _col(c)
    return F.when(F.size(y) > 0, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(y, (i % F.size(y)).cast("int")))).otherwise(F.array_repeat(F.lit(0.0), n))


def mono(left: Column | str, right: Column | str) -> Column:
    return F.zip_with(_col(left), _col(right), lambda a, b: (a + b) / 2)


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    return total(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Inner product of unit vectors, held to [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b)))


def unit(c: Column | str) -> Column:
    """Divided by its length; a zero vector stays."""
    v = _col(c)
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x.cast("double") / F.when(norm == 0, 1.0).otherwise(norm))


def close_vectors(a: Column | str, b: Column | str, absolute: float = 1e-7, relative: float = 1e-5) -> Column:
    return F.forall(F.zip_with(_col(a), _col(b), lambda x, y: F.abs(x - y) <= absolute + relative * F.abs(y)), lambda ok: F.coalesce(ok, F.lit(False)))


def min_max(c: Column | str) -> Column:
    """Scaled to [0, 1]; zeros where all are equal."""
    y = _col(c)
    low, high = F.array_min(y), F.array_max(y)
    return F.transform(y, lambda v: F.when(high > low, (v - low) / (high - low)).otherwise(0.0).cast("double"))


def finite(c: Column | str) -> Column:
    """NaN and infinite elements as 0."""
    return F.transform(_col(c), lambda v: F.when(F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v.cast("double")))


def frame_stats(a: Column | str, b: Column | str, width: int) -> Column:
    """Struct (mean, least, low) of the similarities of frames, width numbers each, of two arrays; low is the 5th percentile, interpolated."""
    x, y = _col(a), _col(b)
    n = F.least(F.size(x), F.size(y)) / width
    at = F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0)))

    def similarity(k: Column) -> Column:
        return cosine(unit(F.slice(x, k * width + 1, F.lit(width))), unit(F.slice(y, k * width + 1, F.lit(width))))

    sims = F.array_sort(F.transform(at, similarity))
    place = (F.size(sims) - 1) * F.lit(0.05)
    low, part = F.get(sims, F.floor(place).cast("int")), place - F.floor(place)
    high = F.coalesce(F.get(sims, F.floor(place).cast("int") + 1), low)
    return F.struct((total(sims) / F.size(sims)).alias("mean"), F.get(sims, F.lit(0)).alias("least"), (low + (high - low) * part).alias("low"))
