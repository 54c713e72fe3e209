"""Near copies that the pipeline's SimHash stage adds to the links of simhash_dedup: five-word shingles, similarity 0.8 or more.

Pairs at that similarity differ in up to 20 of a SimHash's 64 bits, and a radius that wide leaves the grid join of
simhash_dedup nothing to prune: it would compare nearly all pairs. So fingerprints are compared within bands of minimum
hashes: a pair at the similarity ALIKE shares no band with a chance of (1 - ALIKE ** ROWS) ** BANDS, about 2e-6, and one
more alike with less. Of what meets in a band, fingerprints over RADIUS bits apart go; the rest is compared shingle by
shingle, so nothing else links. Buckets are compared in stars first, each bucket's members with one of them. Where links
do not yet connect a bucket, its members meet in a task, with their shingles, and are counted against one another through
an index of those: no pairs are handed on but links, and a bucket of many shingles is dealt out in pairs of blocks.
Shingles are read out anew for the documents that this names, and for no others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, settle, with_keys
from .simhash_dedup import one_of

#: Words of a shingle; least similarity of near copies, as a fraction.
SHINGLE, ALIKE = 5, (4, 5)
#: Bands, hashes in a band; rounds of stars before all pairs left.
BANDS, ROWS, STARS = 25, 4, 2
#: Bits that fingerprints of a pair may differ in; shingles from which on they are compared (at 0.8 a pair is lost with a chance of 1e-6).
RADIUS, LEAST = 24, 32
#: Shingles of a bucket that one task holds at once, about; a bucket of more is dealt out in pairs of blocks.
CELL_SHINGLES = 2_000_000
_CHUNK = 1 << 12
_SEEN = 1 << 18
_MIX = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's word shingles, distinct and in order; fewer words than a shingle are one."""
    words = (data or b"").lower().split()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + shingle])) for i in range(max(min(1, len(words)), len(words) - shingle + 1))), np.uint64))


def band_keys(grams: np.ndarray) -> np.ndarray:
    """A key of each band; none without shingles."""
    if not len(grams):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), _CHUNK):
        mixed = (grams[None, at : at + _CHUNK] ^ _MIX[0]) * _MIX[1]
        low = np.minimum(low, (mixed ^ (mixed >> np.uint64(32))).min(1))
    return np.array([xxhash.xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(low.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def print_of(grams: np.ndarray) -> int:
    """SimHash of distinct shingle hashes, signed."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(grams), _CHUNK):
        counts += np.unpackbits(grams[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(grams)).tobytes(), "big", signed=True)


def name_of(grams: np.ndarray) -> int:
    """What a set of shingles is known by, signed."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, s long, n, fp, keys): one row for each row of df; s names the set of shingles, n is its size; its fingerprint and bands are given once a task at least."""

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            names, sizes, prints, keys = [], [], [], []
            for x in b.column(2):
                own = shingles(x.as_py())
                s = name_of(own)
                new = s not in seen
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(s)
                names.append(s)
                sizes.append(len(own))
                prints.append(print_of(own) if new else None)
                keys.append(band_keys(own) if new else None)
            arrays = [pa.array(names, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], ["doc_id", "text_hash", "s", "n", "fp", "keys"])

    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("data"))
    return own.mapInArrow(run, "doc_id long, text_hash long, s long, n int, fp long, keys array<long>")


def spelled(df: DataFrame, first: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(s, grams): the shingles of the sets in wanted (s), from the text of one document of each, which first (s, doc_id, text_hash) names."""

    def run(batches):
        for b in batches:
            sets = [shingles(x.as_py()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([name_of(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], ["s", "grams"])

    texts = with_keys(df, first.join(wanted, "s"), id_col, text_col).select(F.col(text_col).cast("binary").alias("data"))
    return settle(texts.mapInArrow(run, "s long, grams array<long>").dropDuplicates(["s"]))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with same: whether they are alike."""
    one = pairs.join(sets.select(F.col("s").alias("a"), F.col("grams").alias("ga")), "a")
    both = one.join(sets.select(F.col("s").alias("b"), F.col("grams").alias("gb")), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    whole = F.size("ga") + F.size("gb") - common
    return both.select("a", "b", (common * ALIKE[1] >= whole * ALIKE[0]).alias("same"))


def links(df: DataFrame, own: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, root) of the sets of own, the signatures of df, that have near copies: root is the smallest set reachable. Texts without words have no bands."""
    once = own.where("keys is not null and n > 0").select("s", "n", "fp", "keys").dropDuplicates(["s"])
    at = once.select("s", "n", "fp", F.explode("keys").alias("key"))
    first = settle(own.groupBy("s").agg(F.min(F.struct("doc_id", "text_hash")).alias("x")).select("s", "x.doc_id", "x.text_hash"))
    full = at.groupBy("key").agg(F.min("s").alias("_x"), F.max("s").alias("_y")).where("_x <> _y").select("key")
    at = settle(at.join(full, "key"))
    fits = F.least("n", "m") * ALIKE[1] >= F.greatest("n", "m") * ALIKE[0]
    fits = fits & ((F.least("n", "m") < LEAST) | (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS))
    tested = settle(own.select(F.col("s").alias("a"), F.col("s").alias("b"), F.lit(False).alias("same")).limit(0))
    roots = tested.select(F.col("a").alias("node"), F.col("b").alias("root"))
    sets = None

    def still_apart(roots: DataFrame) -> DataFrame:
        live = at.join(roots, at.s == roots.node, "left").select("key", "s", "n", "fp", F.coalesce("root", "s").alias("label"))
        mixed = live.groupBy("key").agg(F.min("label").alias("_x"), F.max("label").alias("_y")).where("_x <> _y").select("key")
        return settle(live.join(mixed, "key"))

    def with_more(sets: DataFrame | None, named: DataFrame) -> DataFrame:
        more = spelled(df, first, named if sets is None else named.join(sets, "s", "left_anti"), id_col, text_col)
        return more if sets is None else sets.union(more)

    for k in range(STARS):
        live = still_apart(roots)
        if live.isEmpty():
            return roots
        other = live.select("key", F.col("s").alias("t"), F.col("n").alias("m"), F.col("fp").alias("fp2"), F.col("label").alias("far"))
        middle = live.groupBy("key").agg(F.min(F.struct(F.xxhash64("s", F.lit(k)).alias("h"), "s", "n", "fp", "label")).alias("x"))
        met = other.join(middle.select("key", "x.s", "x.n", "x.fp", "x.label"), "key").where("far <> label")
        pairs = met.where(fits).select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()
        pairs = settle(pairs.join(tested, ["a", "b"], "left_anti"))
        sets = with_more(sets, pairs.select(F.col("a").alias("s")).union(pairs.select("b")).distinct())
        tested = settle(tested.union(_confirmed(pairs, sets)))
        roots = components(tested.where("same").select("a", "b"))
    live = still_apart(roots)
    if live.isEmpty():
        return roots
    sets = with_more(sets, live.select("s").distinct())
    found = met_in_buckets(live, sets)
    return components(tested.where("same").select("a", "b").union(found))


def linked(labels: list[int], grams: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of places that are alike and lie in different groups, labels and earlier links taken together: as many as connect what is alike."""
    n = np.array([len(g) for g in grams])
    row, (_, group) = np.repeat(np.arange(len(grams)), n), np.unique(np.array(labels), return_inverse=True)
    _, term = np.unique(np.concatenate(grams), return_inverse=True)
    order = np.argsort(term, kind="stable")
    holders, ends = row[order], np.concatenate(([0], np.cumsum(np.bincount(term))))
    first = np.concatenate(([0], np.cumsum(n)))
    out = []
    for i in range(len(grams)):
        if (group == group[i]).all():
            break
        terms = term[first[i] : first[i + 1]]
        common = np.bincount(np.concatenate([holders[ends[t] : ends[t + 1]] for t in terms.tolist()]), minlength=len(grams))
        alike = np.flatnonzero((common * ALIKE[1] >= (n + n[i] - common) * ALIKE[0]) & (group != group[i]))
        for j in alike.tolist():
            if group[j] != group[i]:
                out.append((i, j))
                group[group == group[j]] = group[i]
    return out


def met_in_buckets(live: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between sets of one bucket and different labels, as many as connect what is alike. live: (key, s, n, label)."""
    sizes = settle(live.groupBy("key").agg(F.ceil(F.sum("n") * 2 / CELL_SHINGLES).cast("int").alias("blocks")).where("blocks > 1"))

    def compare(batches):
        now, names, labels, grams = None, [], [], []

        def given():
            found = linked(labels, grams) if len(names) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in found], pa.int64()), pa.array([names[j] for _, j in found], pa.int64())], ["a", "b"])

        for b in batches:
            for key, block, s, label, g in zip(*[b.column(c).to_pylist() for c in range(4)], b.column(4), strict=True):
                if (key, block) != now:
                    if now is not None:
                        yield given()
                    now, names, labels, grams = (key, block), [], [], []
                names.append(s)
                labels.append(label)
                grams.append(g.values.to_numpy())
        if now is not None:
            yield given()

    mine = F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int")
    with_blocks = live.join(sizes, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", mine)
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, F.col("mine")).cast("long") * 1_000_000 + F.greatest(x, F.col("mine")))
    dealt = with_blocks.select("key", "s", "label", F.explode(met).alias("block")).join(sets, "s")
    dealt = dealt.select("key", "block", "s", "label", "grams").repartition("key", "block").sortWithinPartitions("key", "block", "s")
    return dealt.mapInArrow(compare, "a long, b long")


def joined(roots: DataFrame, own: DataFrame, found: DataFrame) -> DataFrame:
    """roots (node, root) of the sets of own after the components of found (text_hash, root) join theirs: root is the smallest set reachable by links of either kind."""
    sets = own.select("text_hash", "s").distinct().join(roots, F.col("s") == F.col("node"), "left").select("text_hash", "s", F.coalesce("root", "s").alias("near"))
    sets = settle(sets)
    both = settle(sets.join(found.select("text_hash", F.col("root").alias("print")).distinct(), "text_hash").select("print", "near").distinct())
    least = both.groupBy("print").agg(F.min("near").alias("a"), F.max("near").alias("_x")).where("a <> _x").select("print", "a")
    more = components(both.join(least, "print").where("near <> a").select("a", F.col("near").alias("b")))
    named = sets.select(F.col("s").alias("_s"), "near").distinct().join(more, F.col("near") == F.col("node"), "left")
    return settle(named.select(F.col("_s").alias("node"), F.coalesce("root", "near").alias("root")))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", found: DataFrame | None = None) -> DataFrame:
    """df with one document of each component of near copies: that with the smallest id, then the smallest text hash, then one of its repeats; null ids come last. Texts without words are copies of one another.

    found: simhash_components of df, whose links then count as well.
    """
    own = settle(signatures(df, id_col, text_col))
    roots = links(df, own, id_col, text_col)
    if found is not None:
        roots = joined(roots, own, found)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    sets = own.groupBy("s").agg(first.alias("x"))
    named = sets.join(roots, sets.s == roots.node, "left").select(F.coalesce("root", "s").alias("root"), "x")
    kept = settle(named.groupBy("root").agg(F.min("x").alias("x")).select("x.doc_id", "x.text_hash"))
    return one_of(df, own, kept, id_col, text_col)
