"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Of the k-grams of words in each sliding window the one with the smallest hash is kept. Two texts that share `span`
words keep the same k-gram inside them, at the same place: with k + window - 1 = span no shared span is missed.
Document and benchmark fingerprints meet in an equi-join. Where they meet, the windows of the document through that place
are read out and held, word by word, against the benchmark's windows, so a hash that collides finds nothing.

Nothing on the benchmark's side grows faster than the benchmark: fingerprints carry no words, and each distinct window is
there once, however many items share it, with the name of its set of items; sets are spelled out once for each
combination of them that documents hold. Documents are read in parts of PART words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, repeated, settle, without

#: Words of a window; words of a k-gram; the separators between words once A-Z are lower-cased.
SPAN, GRAM = 13, 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A share of hit words of at least 1 in this many contaminates.
SHARE = 20
#: Distinct fingerprints of the benchmark (a number and a length each) that are broadcast at a time; more are joined in blocks, a scan of the documents each.
BLOCK_ROWS = 1_000_000
#: Words of a part of a document; the windows that begin in a part lie in it whole, so parts overlap by a span less one.
PART = 4096
#: Bits of a packed fingerprint that hold the position (268 million words).
_POS = 28


def words(c: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(c), F.lit("")), SEPARATORS), "")


def _grams(w: Column, gram: int) -> Column:
    """Packed hashes (hash above, position below) of all grams of an array of words that has one at least."""
    mask = (1 << (63 - _POS)) - 1

    # Elements are read one by one: slice() copies the whole array first, which on long texts costs the square of their length.
    def packed(i: Column) -> Column:
        h = F.xxhash64(*[F.get(w, i + j) for j in range(gram)]).bitwiseAND(F.lit(mask))
        return F.shiftleft(h, _POS).bitwiseOR(i.cast("long"))

    return F.transform(F.sequence(F.lit(0), F.size(w) - gram), packed)


def _lowest(grams: Column, window: int) -> Column:
    """Distinct smallest of each window of packed hashes."""
    if window == 1:
        return grams
    starts = F.sequence(F.lit(0), F.size(grams) - window)
    return F.array_distinct(F.transform(starts, lambda i: F.least(*[F.get(grams, i + j) for j in range(window)])))


def winnow(w: Column, span: int, gram: int = GRAM) -> Column:
    """Packed fingerprints (hash above, position below) of an array of words: those of the smallest hash of each window. Fewer than span words: none."""
    return winnowed(w, [span], gram)


def _own(span: int) -> int:
    """What sets the fingerprints of one length apart from another's; nothing for SPAN."""
    return 0 if span == SPAN else (span * 0x9E3779B1 & ((1 << (63 - _POS)) - 1)) << _POS


def winnowed(w: Column, spans: list[int], gram: int = GRAM) -> Column:
    """Packed fingerprints for windows of each length in spans, one after the other; the hashes of grams are computed once for all lengths that hold one."""
    none = F.array().cast("array<bigint>")

    def chosen(grams: Column, size: int, s: int) -> Column:
        found = _lowest(grams, s - size + 1)
        found = F.transform(found, lambda x: x.bitwiseXOR(F.lit(_own(s)))) if _own(s) else found
        return F.when(F.size(grams) >= s - size + 1, found).otherwise(none)

    def of_size(size: int) -> Column:
        mine = [s for s in spans if min(gram, s) == size]
        # A let-binding: the hashes are computed once, as the only element of an array.
        bound = F.transform(F.array(_grams(w, size)), lambda g: F.concat(*[chosen(g, size, s) for s in mine]))
        return F.when(F.size(w) >= size, F.element_at(bound, 1)).otherwise(none)

    return F.concat(*[of_size(size) for size in sorted({min(gram, s) for s in spans})])


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, _POS)


def _pos_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _POS) - 1)).cast("int")


def _window(w: Column, at: Column, span: Column) -> Column:
    """Words at, ..., at + span - 1 as one string; words hold no space."""
    return F.array_join(F.transform(F.sequence(F.lit(0), span - 1), lambda x: F.get(w, at + x)), " ")


def item_windows(bench: DataFrame, span: int = SPAN, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """The benchmark's fingerprints (h, span), windows (win, n, set_id) and sets (set_id, items), each row once, and the span lengths that occur.

    Items without words have none. Equal items count apart; items with a null id are in no set, but their windows count.
    """
    items = bench.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    items = settle(items.withColumn("span", F.least(F.size("w"), F.lit(span))))
    spans = sorted(r[0] for r in items.select("span").distinct().collect())  # span numbers at most
    parts = [items.where(F.col("span") == s).select("span", F.explode(winnowed(F.col("w"), [s])).alias("p")) for s in spans or [span]]
    prints = settle(reduce(DataFrame.union, parts).select(_hash_of(F.col("p")).alias("h"), "span").distinct())
    starts = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("span")), lambda i: _window(F.col("w"), i, F.col("span")))
    each = items.select("item", "span", F.explode(starts).alias("win"))
    grouped = each.groupBy("win").agg(F.max("span").alias("n"), F.array_sort(F.collect_set("item")).alias("items"))
    grouped = settle(grouped.withColumn("set_id", F.sha2(F.to_json("items"), 256)))
    return prints, grouped.select("win", "n", "set_id"), grouped.select("set_id", "items").dropDuplicates(["set_id"]), spans


def _parts(text: Column, span: int) -> Column:
    """(n, parts): the number of words of a text and its words in parts that overlap by span - 1; the text is split once."""

    def cut(w: Column) -> Column:
        n = F.size(w)
        many = F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / PART).cast("int")),
            lambda c: F.transform(F.sequence(c * PART, F.least(n, (c + 1) * PART + span - 1) - 1), lambda i: F.get(w, i)),
        )
        return F.struct(n.alias("n"), F.when(n <= PART, F.array(w)).otherwise(many).alias("parts"))

    return F.element_at(F.transform(F.array(words(text)), cut), 1)


def _covered(runs: Column) -> Column:
    """Number of places covered by an array of (lo, hi)."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda s, r: F.struct((s["n"] + F.greatest(r["hi"] - F.greatest(r["lo"], s["end"]), F.lit(0))).alias("n"), F.greatest(s["end"], r["hi"]).alias("end"))
    return F.aggregate(F.array_sort(runs), start, step, lambda s: s["n"])


def benchmark_hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", span: int = SPAN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, text_hash, n_words, runs, n_items, items_sha256, n_copies) with one row for each distinct (id, text) of docs.

    runs: the (lo, hi) stretches of hit words; n_items, items_sha256: number of the benchmark items with occurring
    windows, and digest of their ids as strings; n_copies: how often the row occurs. A null text has no words; null ids are
    one id. Benchmark fingerprints are broadcast in blocks of block_rows at most, by hash, so that any benchmark fits.
    Empty tables: no rows, or no hits.
    """
    prints, windows, sets, spans = item_windows(bench, span, item_col, item_text)
    blocks = max(1, -(-prints.count() // block_rows))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), _parts(F.col(text_col), span).alias("x"))
    own = own.select("doc_id", "text_hash", F.col("x.n").alias("n_words"), F.posexplode("x.parts").alias("c", "w"))
    # A mark of hash -1 goes first in each document and meets a row without a span: it keeps documents without hits,
    # and the join can be an inner one, so that only what meets is handed on with its words.
    mark = docs.sparkSession.createDataFrame([(-1, None)], "h long, span int")
    rows = []
    for k in range(blocks):
        here = prints if blocks == 1 else prints.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == k)
        found = winnowed(F.col("w"), spans or [span])
        # The mark counts once over all blocks and parts.
        found = F.when(F.col("c") == 0, F.concat(F.array(F.lit(-1).cast("bigint")), found)).otherwise(found) if not k else found
        # The outer form: of the inner one the optimizer derives a filter that computes the fingerprints once more.
        flat = own.withColumn("prints", found).select("doc_id", "text_hash", "n_words", "c", "w", F.explode_outer("prints").alias("p"))
        met = flat.join(F.broadcast(here.union(mark) if not k else here), _hash_of(F.col("p")) == F.col("h"))
        at, n = _pos_of(F.col("p")), F.col("span")
        first = F.greatest(F.lit(0), at - n + F.least(n, F.lit(GRAM)))
        last = F.least(at, F.size("w") - n)
        tried = F.when(n.isNull() | (first > last), F.array().cast("array<int>")).otherwise(F.sequence(first, last))
        wins = F.transform(tried, lambda i: F.struct((i + F.col("c") * PART).alias("lo"), _window(F.col("w"), i, F.col("span")).alias("win")))
        # No filter here: it would become a condition of the join, which then copied the words for each fingerprint.
        rows.append(met.select("doc_id", "text_hash", "n_words", n.isNull().alias("own"), wins.alias("wins")))
    every = settle(reduce(DataFrame.union, rows))
    marks = every.where("own").groupBy("doc_id", "text_hash").agg(F.max("n_words").cast("long").alias("n_words"), F.count(F.lit(1)).alias("n_copies"))
    tried = every.where("size(wins) > 0").select("doc_id", "text_hash", F.explode("wins").alias("x")).select("doc_id", "text_hash", "x.lo", "x.win").distinct()
    hits = tried.join(windows, "win").select("doc_id", "text_hash", F.struct("lo", (F.col("lo") + F.col("n")).alias("hi")).alias("run"), "set_id")
    hits = hits.groupBy("doc_id", "text_hash").agg(F.collect_set("run").alias("runs"), F.array_sort(F.collect_set("set_id")).alias("sets"))
    hits = settle(hits.withColumn("combined", F.sha2(F.concat_ws(",", "sets"), 256)))
    # Documents with one passage in common hold the same sets, however many they are: a set is spelled out once for all of them.
    combined = hits.select("combined", "sets").dropDuplicates(["combined"]).select("combined", F.explode("sets").alias("set_id"))
    spelled = combined.join(sets, "set_id").select("combined", F.explode_outer("items").alias("item")).groupBy("combined").agg(F.array_sort(F.collect_set("item")).alias("items"))
    spelled = settle(spelled.select("combined", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")))
    hits = hits.join(spelled, "combined").select("doc_id", "text_hash", "runs", "n_items", "items_sha256")
    other = hits.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "runs", "n_items", "items_sha256")
    joined = marks.join(other, marks["doc_id"].eqNullSafe(other["_id"]) & (marks["text_hash"] == other["_hash"]), "left")
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("runs", F.array().cast("array<struct<lo:int,hi:int>>")).alias("runs"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        "n_copies",
    )


def judged(docs: DataFrame, bench: DataFrame, **names) -> DataFrame:
    """One row for each row of docs: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = benchmark_hits(docs, bench, **names)
    out = hits.select("doc_id", "text_hash", "n_words", _covered(F.col("runs")).cast("long").alias("n_hit"), "n_items", "items_sha256", "n_copies")
    return repeated(out, "n_copies").withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the contaminated rows; null ids are kept or dropped by their text like any other, and repeated rows together. Empty docs stay empty."""
    return without(docs, judged(docs, bench, id_col=id_col, text_col=text_col).where("contaminated"), id_col, text_col)


def result(docs: DataFrame, bench: DataFrame) -> DataFrame:
    return judged(docs, bench).drop("text_hash")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), i AS (
  SELECT DISTINCT item, least(len(w), 13) AS t, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda s: array_to_string(list_slice(w, s, s + least(len(w), 13) - 1), ' '))) AS win
  FROM b WHERE len(w) > 0
), t AS (SELECT DISTINCT t FROM i), g AS (
  SELECT rid, t, unnest(range(1, len(w) - t + 2)) AS s, unnest(list_transform(range(1, len(w) - t + 2), lambda s: array_to_string(list_slice(w, s, s + t - 1), ' '))) AS win
  FROM d, t WHERE len(w) >= t
), m AS (SELECT g.rid, g.s, g.t, i.item FROM g JOIN i ON g.t = i.t AND g.win = i.win),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + t)) AS p FROM (SELECT DISTINCT rid, s, t FROM m)) GROUP BY rid),
n AS (SELECT rid, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN n USING (rid)
"""
