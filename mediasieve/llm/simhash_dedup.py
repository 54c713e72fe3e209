"""SimHash near-duplicates: segment-popcount embedding, grid range join under Manhattan distance, exact check.

The number of set bits in each short segment of a fingerprint is a coordinate; flipping a bit moves one coordinate
by one, so Manhattan distance between such vectors never exceeds Hamming distance. The segments form bands with a
radius each, the radii plus one adding up to more than the allowed distance: two fingerprints that link lie within the
radius of one another in one band at least. A point is stored in its own grid cell of each band and looks into the cells
at up to that radius (one of every two opposite steps: the other point makes the other). Points that meet in a cell are
compared bit by bit.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, fresh, labels_of, settle, unsigned_hex, with_keys, without

RADIUS = 4
#: Each band: (first bit, bits, bits in a segment, radius); sum of radius + 1 is RADIUS + 1. The second set has wider bands, for more fingerprints than WIDE_ABOVE.
BANDS = ((0, 22, 2, 1), (22, 22, 2, 1), (44, 20, 2, 0))
WIDE_BANDS = ((0, 32, 2, 2), (32, 32, 2, 1))
WIDE_ABOVE = 50_000_000
#: Points that one task compares at once; a cell with more is dealt out in pairs of blocks.
CELL_POINTS = 200_000
_CHUNK = 1 << 16


def fingerprint(data: bytes | None, shingle: int = 4) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit number; 0 for no words."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, n, _CHUNK):
        pairs = zip(starts[at : min(n, at + _CHUNK)].tolist(), last[at : at + _CHUNK].tolist(), strict=False)
        hashes = np.frombuffer(b"".join([digest(joined[i:j], 42) for i, j in pairs]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp long): one row for each row of df; the text itself isn't moved. Null text: as empty."""

    def run(batches):
        for b in batches:
            out = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out.view(np.int64))], ["doc_id", "text_hash", "fp"])

    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("data"))
    return own.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _steps(dims: int, radius: int) -> list[tuple[tuple[int, int], ...]]:
    """Non-zero steps of at most radius in Manhattan distance, one of each two opposite ones, as ((dimension, change), ...)."""
    out = []
    if radius >= 1:
        out += [((d, 1),) for d in range(dims)]
    if radius >= 2:
        out += [((d, 2),) for d in range(dims)]
        out += [((d, 1), (e, s)) for d, e in itertools.combinations(range(dims), 2) for s in (1, -1)]
    if radius > 2:
        raise ValueError("radius of a band: 2 at most")
    return out


def cells(fps: np.ndarray, bands=BANDS):
    """(cell, index of the fingerprint, whether the cell is its own) of all bands, as arrays."""
    fps = fps.view(np.uint64)
    for k, (first, bits, width, radius) in enumerate(bands):
        dims = bits // width
        part = [(fps >> np.uint64(first + d * width)) & np.uint64((1 << width) - 1) for d in range(dims)]
        coords = [np.bitwise_count(p).astype(np.int64) for p in part]
        weight = [(width + 1) ** d for d in range(dims)]
        own = sum(c * w for c, w in zip(coords, weight, strict=True)) + (k << 56)
        index = np.arange(len(fps))
        yield own, index, np.ones(len(fps), bool)
        for step in _steps(dims, radius):
            fits = np.ones(len(fps), bool)
            for d, by in step:
                fits &= (coords[d] + by >= 0) & (coords[d] + by <= width)
            at = index[fits]
            yield own[at] + sum(by * weight[d] for d, by in step), at, np.zeros(len(at), bool)


def _linked(fps: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the points of one cell that leave the same components as all pairs within radius of which one lives in the cell."""
    home = np.flatnonzero(own)
    if not len(home) or len(fps) < 2:
        return home[:0], home[:0]
    if len(home) * len(fps) <= 1 << 20:
        near = np.bitwise_count(fps[home][:, None] ^ fps[None, :]) <= radius
        i, j = np.nonzero(near)
        i = home[i]
        keep = i != j
        if not keep.any():
            return home[:0], home[:0]
        label = labels_of(len(fps), i[keep], j[keep])
        at = np.flatnonzero(label != np.arange(len(fps)))
        return label[at], at
    # Many points: walk each component, comparing what was reached last with what wasn't reached yet; a tight group costs little more than its size.
    left = np.ones(len(fps), bool)
    a, b = [], []
    for seed in home:
        if not left[seed]:
            continue
        left[seed] = False
        front = np.array([seed])
        while len(front):
            reached = []
            for at in range(0, len(front), 64):
                some = front[at : at + 64]
                rest = np.flatnonzero(left)
                if not len(rest):
                    break
                near = np.bitwise_count(fps[some][:, None] ^ fps[rest][None, :]) <= radius
                near &= own[some][:, None] | own[rest][None, :]
                hit = rest[near.any(axis=0)]
                left[hit] = False
                reached.append(hit)
            front = np.concatenate(reached) if reached else front[:0]
            a.append(np.full(len(front), seed))
            b.append(front)
    return np.concatenate(a), np.concatenate(b)


def links(distinct_fps: DataFrame, radius: int = RADIUS, bands=BANDS, cell_points: int = CELL_POINTS) -> DataFrame:
    """(a, b long) links among the fingerprints (fp long) that give the components of all pairs at radius bits or fewer."""
    assert radius == RADIUS and sum(r + 1 for *_, r in bands) > radius

    def spread(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for cell, at, own in cells(fps, bands):
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fps[at]), pa.array(own)], ["cell", "fp", "own"])

    def reduce(a: list, b: list):
        """Links of several cells, as a forest."""
        a, b = np.concatenate(a), np.concatenate(b)
        nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = labels_of(len(nodes), where[: len(a)], where[len(a) :])
        at = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[label[at]]), pa.array(nodes[at])], ["a", "b"])

    def compare(batches):
        held, found_a, found_b, count = None, [], [], 0
        done = False
        batches = iter(batches)
        while not done:
            b = next(batches, None)
            done = b is None
            if not done:
                new = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None or not len(held[0]):
                continue
            cell, block, fp, own = held
            cut = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1])) + 1
            bounds = np.concatenate(([0], cut, [len(cell)]))
            if not done:
                bounds = bounds[:-1]
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if j - i > 1:
                    a, c = _linked(fp[i:j].view(np.uint64), own[i:j], radius)
                    if len(a):
                        found_a.append(fp[i:j][a])
                        found_b.append(fp[i:j][c])
                        count += len(a)
            held = [x[bounds[-1] :] for x in held]
            if count > 1 << 20:
                r = reduce(found_a, found_b)
                found_a, found_b, count = [r.column(0).to_numpy()], [r.column(1).to_numpy()], r.num_rows
                if count > 1 << 19:
                    yield r
                    found_a, found_b, count = [], [], 0
        if count:
            yield reduce(found_a, found_b)

    at = distinct_fps.select("fp").mapInArrow(spread, "cell long, fp long, own boolean")
    hot = settle(at.groupBy("cell").count().where(F.col("count") > cell_points))
    if hot.isEmpty():
        at = at.withColumn("block", F.lit(0).cast("long"))
    else:
        blocks = F.ceil(F.col("count") * 2 / cell_points).cast("int")
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, F.col("mine")).cast("long") * 1_000_000 + F.greatest(x, F.col("mine")))
        joined = at.join(hot, "cell", "left").withColumn("blocks", F.coalesce(blocks, F.lit(1))).withColumn("mine", mine)
        at = joined.select("cell", "fp", "own", F.explode(met).alias("block"))
    dealt = at.select("cell", "block", "fp", "own").repartition("cell", "block").sortWithinPartitions("cell", "block", "fp")
    return dealt.mapInArrow(compare, "a long, b long")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp long, component_id, root): one row for each row of df; root is the component's smallest fingerprint.

    component_id is the smallest id reachable over fingerprints at RADIUS bits or fewer. Texts without words, null ones
    too, have fingerprint 0 and link like any other. Repeated rows give repeated rows. A null id is never the smallest:
    a component of null ids alone has a null component_id. An empty table gives no rows; other columns are ignored.
    """
    own = settle(fingerprints(df, id_col, text_col, shingle))
    fps = settle(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(fps, bands=BANDS if fps.count() <= WIDE_ABOVE else WIDE_BANDS))
    known = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    known = settle(known)
    named = known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root")
    return own.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def one_of(df: DataFrame, found: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of df that kept names (doc_id, text_hash), repeats once; found has doc_id and text_hash of all rows. Few texts move: what goes is named, not what stays."""
    counts = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    named = kept.select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h"))
    counts = settle(counts.join(named, counts["doc_id"].eqNullSafe(named["_i"]) & (counts["text_hash"] == named["_h"]), "left"))
    out = without(df, counts.where("_h is null"), id_col, text_col)
    several = counts.where("_h is not null and n > 1")
    if several.isEmpty():
        return out
    mark = fresh(df, "_hash")
    again = with_keys(out, several, id_col, text_col).withColumn(mark, F.xxhash64(text_col)).dropDuplicates([id_col, mark]).drop(mark)
    return without(out, several, id_col, text_col).union(again)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one document of each component: that with the smallest id, then the smallest text hash, then one of its repeats.

    Null ids come last: of a component of null ids alone the smallest text hash stays.
    """
    found = settle(simhash_components(df, id_col, text_col))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("x")
    kept = settle(found.groupBy("root").agg(first).select("x.doc_id", "x.text_hash"))
    return one_of(df, found, kept, id_col, text_col)


def result(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = simhash_components(df)
    return found.select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")
