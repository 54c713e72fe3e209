"""Brown's class-based bigram model, its classes found by exchange.

All training text is counted, and every word that occurs in it gets a class by likelihood. To begin with, exchange moves
the most frequent words (WORDS of them) by the bigrams among them; given these classes, each other of the HEAD most
frequent words goes to its best class, then every other word does. Then sweeps move every word of the vocabulary once
each, by all its bigrams, whatever the neighbour: the first WORDS one after another, all others in tasks, each leaving its
class first. A sweep that makes the class bigrams of the text less likely is not taken. A word's neighbours outside the
head tell it their classes; what is gathered grows with the vocabulary, and no task holds more than a few words' rows.
A word's probability is that of its class after the class before it, times its own share of the class, with discounts
that leave a share to words never seen, whose class is that of most rare words with their ending.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, sparing
from .labelled import remainder

#: Words that exchange moves one by one, the end token among them; endings, and bytes of an ending, for unseen words; classes; rounds of exchange; words known to every task by number, at most.
WORDS, ENDINGS, TAIL, CLASSES, ROUNDS, HEAD = 2048, 512, 3, 128, 6, 131_072
#: The end token (no word is empty); its number is 0.
END = b""
#: Sweeps over the whole vocabulary, at most.
SWEEPS = 1
#: Tokens, and bytes of text, that a task counts at once; rows that it takes, and whose gains it holds, at once; counts with a table of gains.
_TOKENS, _BYTES, _ROWS, _GAINS, _SMALL = 1 << 18, 1 << 22, 1 << 15, 1 << 12, 15
#: Numbers of words outside the head, for contexts: this bit and 50 bits of a hash. Two words that share one share a class.
_RARE = 1 << 50
#: Words of the head whose counts meet in an array, and in a task.
_PART = 128


def tokens(data: bytes | None) -> list[bytes]:
    return [*(data or b"").lower().split(), END]


def _split(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The tokens of all texts in a row, without end tokens, and how many each text has (the same as tokens gives)."""
    lowered = pc.ascii_lower(pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), -1, texts.offset))  # the bytes need not be UTF-8
    found = pc.ascii_split_whitespace(lowered)
    words, ends = found.flatten(), found.offsets.to_numpy().astype(np.int64)
    words = pa.Array.from_buffers(pa.binary(), len(words), words.buffers(), -1, words.offset)
    some = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))
    return words.filter(some), np.diff(before[ends - ends[0]])


def counts(texts: DataFrame) -> DataFrame:
    """(word string, c long) of texts (text), end tokens as the empty word; summed in the tasks first."""

    def run(batches):
        for b in batches:
            words, _ = _split(b.column(0))
            seen = words.value_counts()
            yield pa.RecordBatch.from_arrays([seen.field(0), seen.field(1)], ["word", "c"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([b.num_rows], pa.int64())], ["word", "c"])

    return texts.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def unit_of(word: bytes, unit: dict[bytes, int]) -> int:
    """The number of a word that exchange moved, else that of its ending."""
    got = unit.get(word)
    return got if got is not None else WORDS + ending(word)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-TAIL:]) % ENDINGS


def names_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """What tells words outside the head apart: 64 bits of a hash, and 23 more of it above the ending's 9."""
    bits = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
    ends = np.fromiter(map(zlib.crc32, [w[-TAIL:] for w in words]), np.uint32, len(words)) % np.uint32(ENDINGS)
    second = (bits[:, 1] & np.uint64(0xFFFFFFFF & -ENDINGS)).astype(np.uint32) | ends
    return bits[:, 0].view(np.int64), second.view(np.int32)


def numbers_of(names: np.ndarray) -> np.ndarray:
    """Numbers of words outside the head, from the first part of their names."""
    return names & (_RARE - 1) | _RARE


def sequences(docs: DataFrame, head: dict[bytes, int]) -> DataFrame:
    """docs without text, with ids (numbers of the tokens in the head's order, -1 for others), rare and rare2 (names of those others, in order), packed: texts are tokenised once."""
    names = [c for c in docs.columns if c != "text"]
    own = docs.select(*names, F.col("text").cast("binary"))
    schema = docs.select(*names).schema.add("ids", "binary").add("rare", "binary").add("rare2", "binary")
    sent = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(head)})  # HEAD words at most

    def run(batches):
        get = sent.value.get
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(len(names))), 0).to_numpy())
            first = 0
            while first < b.num_rows:
                upto = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _BYTES)))
                some = b.slice(first, upto - first)
                first = upto
                words, sizes = _split(some.column(len(names)))
                words = words.dictionary_encode()
                each, place = words.dictionary.to_pylist(), words.indices.to_numpy()
                number = np.fromiter(map(get, each, repeat(-1)), np.int32, len(each))
                ids, at, other = number[place], np.cumsum(sizes), number < 0
                rare = place[ids < 0]
                found = [x[(np.cumsum(other) - 1)[rare]] for x in names_of([each[k] for k in np.flatnonzero(other).tolist()])]
                rare_ends = np.concatenate(([0], np.cumsum(ids < 0)))[np.concatenate(([0], at))]
                arrays = [_packed(np.insert(ids, at, get(END)), np.concatenate(([0], at + np.arange(1, len(at) + 1))))]
                arrays += [_packed(x, rare_ends) for x in found]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], *arrays], [*names, "ids", "rare", "rare2"])

    return own.mapInArrow(run, schema)


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of numbers as binary; row i ends where ends[i + 1] says."""
    at = np.array(ends, np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.BinaryArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows in a row, and how many each row has."""
    size = np.dtype(kind).itemsize
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    found = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(found.tobytes(), kind), np.diff(ends) // size


def _neighbours(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each token's predecessor and of the token, all texts of a batch in a row; before the first stands the end token, as each text ends with it."""
    ids = _unpacked(batch.column(0), np.int32)[0].astype(np.int64)
    ids[ids < 0] = numbers_of(_unpacked(batch.column(1), np.int64)[0])
    return np.concatenate(([0], ids[:-1])), ids


def _classes(label: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Classes of words by number; -1 for those outside the head or without a class yet."""
    return np.where(numbers < len(label), label[np.minimum(numbers, len(label) - 1)], -1)


def _dealt(keys: np.ndarray, n: np.ndarray, span: int) -> pa.RecordBatch:
    """(part, steps, n): counts of keys, which ascend, a part for each span of them; a row holds its keys' differences."""
    parts = keys // span
    starts = _starts(parts) if len(keys) else np.zeros(0, np.int64)
    steps, ends = np.diff(keys, prepend=0), np.append(starts, len(keys))
    steps[starts] = keys[starts] % span
    return pa.RecordBatch.from_arrays([pa.array(parts[starts].astype(np.int32)), _packed(steps.astype(np.int32), ends), _packed(n.astype(np.int32), ends)], ["part", "steps", "n"])


def unit_bigrams(seqs: DataFrame) -> np.ndarray:
    """Counts of pairs of the first WORDS words, from which exchange starts; at most WORDS^2 sums come to the driver. All other pairs count in the sweeps."""

    def run(batches):
        sums = np.zeros(WORDS * WORDS, np.int32)
        for b in batches:
            before, now = _neighbours(b)
            both = (before < WORDS) & (now < WORDS)
            key, n = np.unique(before[both] * WORDS + now[both], return_counts=True)
            sums[key] += n.astype(np.int32)
        at = np.flatnonzero(sums)
        for i in range(0, len(at), 1 << 18):
            some = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some].astype(np.int64))], ["pair", "n"])

    found = seqs.select("ids", "rare").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(WORDS * WORDS)
    got = found.toArrow()
    out[got["pair"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(WORDS, WORDS)


def _class_pairs(seqs: DataFrame, label: np.ndarray) -> np.ndarray:
    """Counts of pairs of classes of words in the head."""
    sent = seqs.sparkSession.sparkContext.broadcast(label)

    def run(batches):
        label, sums = sent.value, np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            u, v = _neighbours(b)
            ku, kv = _classes(label, u), _classes(label, v)
            both = (ku >= 0) & (kv >= 0)
            sums += np.bincount(ku[both] * CLASSES + kv[both], minlength=CLASSES * CLASSES)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["key", "n"])

    return _grid(seqs.select("ids", "rare").mapInArrow(run, "key long, n long"))


def _grid(pairs: DataFrame) -> np.ndarray:
    """Counts (key: class * CLASSES + class, n) as a matrix; CLASSES^2 sums come to the driver."""
    out = np.zeros(CLASSES * CLASSES)
    got = pairs.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out[got["key"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(CLASSES, CLASSES)


def _tables(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of grid by slot and class of the word, and what up to _SMALL bigrams more add to each."""
    cells = np.concatenate([grid.T, grid])
    known = _f(cells)
    return cells, np.stack([_f(cells + k) - known for k in range(_SMALL + 1)]).astype(np.float32)


def _lost(sums: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """What the sums of rows or columns take from the gain of words that add extra to them, by class."""
    few = _f(sums + np.arange(_SMALL + 1.0)[:, None]) - _f(sums)
    got = few[np.minimum(extra, _SMALL).astype(np.int64)]
    many = extra > _SMALL
    got[many] = _f(sums + extra[many][:, None]) - _f(sums)
    return got


def best_class(starts: np.ndarray, slot: np.ndarray, n: np.ndarray, grid: np.ndarray, tables: tuple | None = None) -> np.ndarray:
    """The class where each word gains most likelihood of class bigrams, added to grid by itself. Rows (slot, n) from starts[i] on are word i's; tables: _tables(grid)."""
    classes = len(grid)
    cells, small = tables or _tables(grid)
    ends = np.append(starts[1:], len(slot))
    out = np.empty(len(starts), np.int64)
    rows, cols, corner = grid.sum(1), grid.sum(0), np.diag(grid)
    ahead = slot < classes
    word = np.repeat(np.arange(len(starts)), ends - starts)
    a = np.bincount(word, weights=n * ahead, minlength=len(starts))
    b = np.bincount(word, weights=n * ~ahead, minlength=len(starts))

    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _GAINS)))
        x, y = starts[i], ends[j - 1]
        few = n[x:y] <= _SMALL
        each = np.empty((y - x, classes), np.float32)
        each[few] = small[n[x:y][few], slot[x:y][few]]
        large = cells[slot[x:y][~few]]
        each[~few] = _f(large + n[x:y][~few][:, None]) - _f(large)
        gain = np.add.reduceat(each, starts[i:j] - x, axis=0, dtype=np.float64)
        gain -= _lost(rows, a[i:j]) + _lost(cols, b[i:j])
        # Where a class holds neighbours before the word, its row's sum grows by them too; likewise behind it.
        w, k, m, to = word[x:y] - i, slot[x:y] % classes, n[x:y], ahead[x:y]
        for side, sums, extra in ((~to, rows, a[i:j]), (to, cols, b[i:j])):
            at, c, d, e = w[side], sums[k[side]], m[side], extra[w[side]]
            gain[at, k[side]] -= _f(c + d + e) - _f(c + d) - _f(c + e) + _f(c)
        beside = np.zeros((j - i, classes), np.float32)
        beside[w[~to], k[~to]] = m[~to]
        both = beside[w[to], k[to]]
        at, c, d = w[to][both > 0], corner[k[to][both > 0]], m[to][both > 0]
        e = both[both > 0]
        gain[at, k[to][both > 0]] += _f(c + d + e) - _f(c + d) - _f(c + e) + _f(c)
        out[i:j] = gain.argmax(1)
        i = j
    return out


def best_move(starts: np.ndarray, slot: np.ndarray, n: np.ndarray, was: np.ndarray, grid: np.ndarray, tables: tuple | None = None) -> np.ndarray:
    """The class where each word gains most if it alone leaves its class (was), in which grid counts it; a word that gains nothing stays. Slots are as in best_class, each at most once a word; slot 2 * classes is the word itself behind itself."""
    classes = len(grid)
    cells, small = tables or _tables(grid)
    ends, out = np.append(starts[1:], len(slot)), np.array(was)
    rows, cols, corner = grid.sum(1), grid.sum(0), np.diag(grid)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _GAINS)))
        x, y, own, each_word = starts[i], ends[j - 1], was[i:j], np.arange(j - i)
        w, s, m = np.repeat(each_word, ends[i:j] - starts[i:j]), slot[x:y], n[x:y].astype(np.float64)
        itself = s == 2 * classes
        loops = np.bincount(w[itself], weights=m[itself], minlength=j - i)
        w, s, m = w[~itself], s[~itself], m[~itself]
        ahead = s < classes
        after, before = np.zeros((j - i, classes)), np.zeros((j - i, classes))
        after[w[ahead], s[ahead]] = m[ahead]
        before[w[~ahead], s[~ahead] - classes] = m[~ahead]
        each = np.empty((len(s), classes), np.float32)
        few = m <= _SMALL
        each[few] = small[m[few].astype(np.int64), s[few]]
        large = cells[s[~few]]
        each[~few] = _f(large + m[~few][:, None]) - _f(large)
        # In its own class it gains what leaving takes; the cells of its own class as a neighbour are less by its other side.
        here = own[w]
        c = cells[s, here]
        each[np.arange(len(s)), here] = _f(c) - _f(c - m)
        for of, beside in ((ahead, before), (~ahead, after)):
            at = np.flatnonzero(of & (s % classes == here))
            c = cells[s[at]] - beside[w[at]]
            each[at] = _f(c + m[at][:, None]) - _f(c)
            each[at, here[at]] = 0
        gain, first = np.zeros((j - i, classes)), np.searchsorted(w, each_word)
        some = np.flatnonzero(np.bincount(w, minlength=j - i))
        if len(some):
            gain[some] = np.add.reduceat(each, first[some], axis=0, dtype=np.float64)
        both = ((after > 0) & (before > 0)) | (loops > 0)[:, None]
        both[each_word, own] = False
        at, k = np.nonzero(both)
        c, d, e = corner[k], after[at, k], before[at, k]
        gain[at, k] += _f(c + d + e + loops[at]) - _f(c + d) - _f(c + e) + _f(c)
        c = corner[own]
        gain[each_word, own] += _f(c) - _f(c - after[each_word, own] - before[each_word, own] - loops)
        for sums, extra in ((rows, after.sum(1) + loops), (cols, before.sum(1) + loops)):
            cost, c = _lost(sums, extra), sums[own]
            cost[each_word, own] = _f(c) - _f(c - extra)
            gain -= cost
        to = gain.argmax(1)
        out[i:j] = np.where(gain[each_word, to] > gain[each_word, own] + 1e-4, to, own)
        i = j
    return out


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows in the order of the first column, many rows at a time; those with one value of it come together."""
    held, size = [], 0
    for b in chain(batches, [None]):
        if b is not None:
            held.append([c.to_numpy() for c in b.columns])
            size += b.num_rows
            if size < _ROWS:
                continue
        if not held:
            return
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        u = columns[0]
        cut = len(u) if b is None else int(np.searchsorted(u, u[-1]))  # the last word may go on
        held, size = [[c[cut:] for c in columns]], len(u) - cut
        if cut:
            yield [c[:cut] for c in columns]


def _starts(u: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(u[1:] != u[:-1]) + 1))


def _rare_words(seqs: DataFrame, label: np.ndarray, grid: np.ndarray) -> DataFrame:
    """(u, k, ids, mates): each word outside the head with its best class by its neighbours in the head, any if it has none; and its neighbours, once for each time: the head's (2 * number, 1 more if it stands before the word) and others."""
    sent = seqs.sparkSession.sparkContext.broadcast((label, grid))

    def meet(batches):
        for b in batches:
            u, v = _neighbours(b)
            ahead, behind = u >= _RARE, v >= _RARE
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((u[ahead], v[behind]), (v[ahead] * 2, u[behind] * 2 + 1))], ["u", "m"])

    def run(batches):
        label, grid = sent.value
        tables = _tables(grid)
        for u, m in _by_word(batches):
            starts = _starts(u)
            word, u = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(u)))), u[starts]
            near = m < _RARE
            key, n = np.unique(word[near] * (2 * CLASSES) + label[m[near] >> 1] + CLASSES * (m[near] & 1), return_counts=True)
            k = u % CLASSES
            if len(key):
                first = _starts(key // (2 * CLASSES))
                k[key[first] // (2 * CLASSES)] = best_class(first, key % (2 * CLASSES), n, grid, tables)
            ends = lambda of: np.concatenate(([0], np.cumsum(np.bincount(word[of], minlength=len(u)))))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(k), _packed(m[near].astype(np.int32), ends(near)), _packed(m[~near], ends(~near))], ["u", "k", "ids", "mates"])

    dealt = seqs.select("ids", "rare").mapInArrow(meet, "u long, m long").repartition("u").sortWithinPartitions("u")
    return settle(dealt.mapInArrow(run, "u long, k long, ids binary, mates binary"))


def _met(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """words with near: slots of their neighbours outside the head, each of which tells its class; only words that have such neighbours move. And the table of those, to be discarded."""

    def tell(batches):
        for b in batches:
            m, sizes = _unpacked(b.column(2), np.int64)
            u, k = (np.repeat(b.column(c).to_numpy(), sizes) for c in range(2))
            v, slot = m >> 1, k + CLASSES * (1 - (m & 1))
            slot[u == v] = 2 * CLASSES
            once = (u != v) | (m & 1 == 0)
            yield pa.RecordBatch.from_arrays([pa.array(v[once]), pa.array(slot[once].astype(np.int32))], ["v", "slot"])

    linked = words.where(F.octet_length("mates") > 0)
    heard = linked.select("u", "k", "mates").mapInArrow(tell, "v long, slot int").groupBy("v").agg(F.collect_list("slot").alias("near"))
    linked = settle(linked.join(heard, F.col("u") == F.col("v")).select("u", "k", "ids", "mates", "near"))
    return linked.union(words.where(F.octet_length("mates") == 0).withColumn("near", F.array().cast("array<int>"))), linked


def _slots_of(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of rows (k, ids, near, ...): the place of the word at each of all ids, those ids, its place at each of all near, and those slots."""
    m, sizes = _unpacked(b.column(1), np.int32)
    near = b.column(2)
    place = np.arange(b.num_rows)
    beside = np.repeat(place, np.diff(near.offsets.to_numpy()))
    return np.repeat(place, sizes), m, beside, near.flatten().to_numpy().astype(np.int64)


def _rare_pairs(met: DataFrame, label: np.ndarray) -> np.ndarray:
    """Counts of pairs of classes with a word outside the head."""
    sent = met.sparkSession.sparkContext.broadcast(label)

    def run(batches):
        label, sums = sent.value, np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            k = b.column(0).to_numpy()
            at, m, beside, slot = _slots_of(b)
            own, other = k[at], label[m >> 1]
            keys = np.where(m & 1, other * CLASSES + own, own * CLASSES + other)
            own = k[beside]
            slot = np.where(slot == 2 * CLASSES, own, slot)  # itself
            more = (own * CLASSES + slot)[slot < CLASSES]  # the other word counts what stands before it
            sums += np.bincount(np.concatenate([keys, more]), minlength=CLASSES * CLASSES)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["key", "n"])

    return _grid(met.select("k", "ids", "near").mapInArrow(run, "key long, n long"))


def _rare_moved(met: DataFrame, grid: np.ndarray, label: np.ndarray) -> DataFrame:
    """The words of met, each in the class of its best move."""
    sent = met.sparkSession.sparkContext.broadcast((grid, label))
    slots = 2 * CLASSES + 1

    def run(batches):
        grid, label = sent.value
        tables = _tables(grid)
        for b in batches:
            at, m, beside, slot = _slots_of(b)
            key, n = np.unique(np.concatenate([at * slots + label[m >> 1] + CLASSES * (m & 1), beside * slots + slot]), return_counts=True)
            if len(key):
                k = best_move(_starts(key // slots), key % slots, n, b.column(0).to_numpy(), grid, tables)
                yield pa.RecordBatch.from_arrays([b.column(3), pa.array(k), b.column(1), b.column(4)], ["u", "k", "ids", "mates"])

    return settle(met.select("k", "ids", "near", "u", "mates").mapInArrow(run, "u long, k long, ids binary, mates binary"))


def likelihood(grid: np.ndarray) -> float:
    """What of the text's log likelihood depends on the classes, from the counts of class bigrams."""
    return float(_f(grid).sum() - _f(grid.sum(1)).sum() - _f(grid.sum(0)).sum())


def _head_assigned(seqs: DataFrame, met: DataFrame | None, label: np.ndarray, core: int, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the head, its words from core on in their best; and for those before, how often each stands beside each class (slots as in best_move).

    Without met, words from core on have no class (-1) yet and get one by their neighbours that do; else they move, by all neighbours.
    """
    slots = 2 * CLASSES + 1
    first, span, anew = core * slots, _PART * slots, met is None
    sent = seqs.sparkSession.sparkContext.broadcast((label, grid))

    def dealt(many):
        """Counts of keys, those of the words before core summed up to the task's end."""
        sums = np.zeros(first, np.int64)
        for keys in many:
            low = keys < first
            sums += np.bincount(keys[low], minlength=first)
            yield _dealt(*np.unique(keys[~low], return_counts=True), span)
        at = np.flatnonzero(sums)
        yield _dealt(at, sums[at], span)

    def among(batches):
        label = sent.value[0]
        for b in batches:
            u, v = _neighbours(b)
            ku, kv = _classes(label, u), _classes(label, v)
            ahead, behind = (u < len(label)) & (kv >= 0), (v < len(label)) & (ku >= 0) & (u != v)
            keys = [u[ahead] * slots + np.where(u == v, 2 * CLASSES, kv)[ahead], v[behind] * slots + CLASSES + ku[behind]]
            yield np.concatenate(keys)

    def beside(batches):
        held, size = [], 0
        for b in chain(batches, [None]):
            if b is not None:
                m, sizes = _unpacked(b.column(1), np.int32)
                held.append((m >> 1).astype(np.int64) * slots + np.repeat(b.column(0).to_numpy(), sizes) + CLASSES * (1 - (m & 1)))
                size += len(m)
            if held and (b is None or size >= _TOKENS):
                yield np.concatenate(held)
                held, size = [], 0

    def run(batches):
        label, grid = sent.value
        tables, now, sums = _tables(grid), None, None

        def given():
            at = np.flatnonzero(sums)
            key, n = at + now * span, sums[at]
            low = np.searchsorted(key, first)
            yield pa.RecordBatch.from_arrays([pa.array(key[:low]), pa.array(np.full(low, -1)), pa.array(n[:low])], ["u", "k", "n"])
            key, n = key[low:], n[low:]
            if len(key):
                starts = _starts(key // slots)
                u = key[starts] // slots
                k = best_class(starts, key % slots, n, grid, tables) if anew else best_move(starts, key % slots, n, label[u], grid, tables)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(k), pa.array(np.zeros(len(u), np.int64))], ["u", "k", "n"])

        for b in batches:
            for part, steps, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if part != now:
                    if now is not None:
                        yield from given()
                    now, sums = part, np.zeros(span, np.int64)
                sums[np.cumsum(np.frombuffer(steps, np.int32))] += np.frombuffer(n, np.int32)
        if now is not None:
            yield from given()

    schema = "part int, steps binary, n binary"
    found = seqs.select("ids", "rare").mapInArrow(lambda batches: dealt(among(batches)), schema)
    if met is not None:
        found = found.union(met.select("k", "ids").mapInArrow(lambda batches: dealt(beside(batches)), schema))
    got = found.repartition("part").sortWithinPartitions("part").mapInArrow(run, "u long, k long, n long").toArrow()  # HEAD + WORDS * slots rows at most
    u, k, n = (c.to_numpy() for c in got.columns)
    out, sums, moved = label.copy(), np.zeros(first), k >= 0
    out[u[moved]] = k[moved]
    sums[u[~moved]] = n[~moved]
    return out, sums.reshape(core, slots)


def _head_moved(seqs: DataFrame, met: DataFrame, pairs: np.ndarray, grid: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Classes of the head after each of its words moved once: those of pairs one after another, the others in tasks."""
    core = len(pairs)
    out, full = _head_assigned(seqs, met, label, core, grid)
    at, own = np.arange(core), np.diag(pairs)
    spot = np.eye(CLASSES)[label[:core]]
    outside = full[:, : 2 * CLASSES] - np.hstack([pairs @ spot, pairs.T @ spot])
    outside[at, label[:core]] += own
    outside[at, CLASSES + label[:core]] += own
    out[:core] = exchange(pairs, CLASSES, 1, (label[:core], outside, grid))
    return out


def _swept(seqs: DataFrame, pairs: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """Classes of the head, the table of those of all other words (u, k among its columns), and counts of all class bigrams, after sweeps from the head's first classes on. Tables of other sweeps go."""
    best, inner = None, _class_pairs(seqs, label)
    words = _rare_words(seqs, label, inner)
    for k in range(SWEEPS + 1):
        met, linked = _met(words)
        grid = inner + _rare_pairs(met, label)
        if best is not None and likelihood(grid) <= likelihood(best[2]):
            discard(words, linked)
            break
        if best is not None:
            discard(best[1])
        best = label, words, grid
        if k < SWEEPS:
            words = _rare_moved(met, grid, label)
            label = _head_moved(seqs, met, pairs, grid, label)
            inner = _class_pairs(seqs, label)
        discard(linked)
    return best


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS, state: tuple | None = None) -> np.ndarray:
    """The class of each unit: units, the most frequent first, go one by one to where the likelihood of class bigrams gains most, until none moves.

    state: their classes so far; how often each stands before and after the classes of other words; and counts of class bigrams, those words' included.
    """
    n = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    spot, outside = np.eye(classes), np.zeros((n, 2 * classes))
    if state is None:
        order = np.argsort(-weight, kind="stable")
        label = np.empty(n, np.int64)
        label[order] = np.arange(n) % classes
        grid = spot[label].T @ pairs @ spot[label]
    else:
        label, outside, grid = (np.array(x) for x in state)
        weight += outside.sum(1)
        order = np.argsort(-weight, kind="stable")
    columns = np.ascontiguousarray(pairs.T)
    diagonal = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not weight[u]:
                continue
            was, own = label[u], pairs[u, u]
            after = np.bincount(label, weights=pairs[u], minlength=classes)
            before = np.bincount(label, weights=columns[u], minlength=classes)
            after[was] -= own
            before[was] -= own
            after, before = after + outside[u, :classes], before + outside[u, classes:]
            grid[was] -= after
            grid[:, was] -= before
            grid[was, was] -= own
            rows, cols = grid.sum(1), grid.sum(0)
            across, down = _f(grid + after[None, :]) - _f(grid), _f(grid + before[:, None]) - _f(grid)
            corner = np.diag(grid)
            gain = across.sum(1) - across[diagonal, diagonal] + down.sum(0) - down[diagonal, diagonal]
            gain += _f(corner + after + before + own) - _f(corner)
            gain -= _f(rows + after.sum() + own) - _f(rows) + _f(cols + before.sum() + own) - _f(cols)
            to = int(np.argmax(gain))
            if gain[to] <= gain[was] + 1e-9:
                to = was
            label[u] = to
            grid[to] += after
            grid[:, to] += before
            grid[to, to] += own
            moved += to != was
        if not moved:
            break
    return label


def _level(vocabulary: DataFrame, most: int) -> tuple[int | None, int, int | None]:
    """The least count that leaves most words at most, or None; how many words have it or more; and the next count below."""
    levels = vocabulary.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(most + 1).collect()
    least, total = None, 0
    for r in levels:
        if total + r["n"] > most:
            return least, total, r["c"]
        total, least = total + r["n"], r["c"]
    return least, total, None


def head_words(vocabulary: DataFrame, most: int | None = None) -> dict[bytes, int]:
    """Counts of all words above the least count that leaves most of them at most; no task ranks the vocabulary."""
    least, _, _ = _level(vocabulary, HEAD if most is None else most)
    if least is None:
        return {}
    top = vocabulary.where(F.col("c") >= least).toArrow()  # most rows at most
    return dict(zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True))


def top_words(vocabulary: DataFrame, most: int | None = None) -> dict[bytes, int]:
    """Counts of the end token (first, 0 if not there) and of the most frequent other words, most in all; by count, equal ones by word."""
    most = HEAD if most is None else most
    others = vocabulary.where(F.length("word") > 0)
    found = head_words(others, most - 1)
    _, total, tied = _level(others, most - 1)
    if tied is not None:  # of the count that doesn't fit whole, the first words
        some = others.where(F.col("c") == tied).orderBy("word").limit(most - 1 - total).toArrow()
        found |= dict(zip(some["word"].to_pylist(), some["c"].to_pylist(), strict=True))
    end = vocabulary.where(F.length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return {END: end} | {w: found[w] for w in sorted(found, key=lambda w: (-found[w], w))}


def train(texts: DataFrame) -> dict:
    """Model of texts (text; null: empty). vocabulary (word, c, k) is a table; all else is bounded by this module's parameters. Without texts all words are unseen.

    Bigrams of classes are counted over all texts and all words.
    """
    with sparing(texts.sparkSession):
        vocabulary = settle(counts(texts))
        head = top_words(vocabulary)
        seqs = settle(sequences(texts.select("text"), head))
        model = _fitted(vocabulary, head, seqs)
        discard(seqs)
        return model


def _fitted(vocabulary: DataFrame, head: dict[bytes, int], seqs: DataFrame) -> dict:
    """The model; discards vocabulary, of which the model has its own table."""
    total, types = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    spark, names = vocabulary.sparkSession, list(head)
    core = min(WORDS, len(names))
    label = np.full(len(names), -1, np.int64)
    pairs = unit_bigrams(seqs)[:core, :core]
    label[:core] = exchange(pairs, CLASSES, ROUNDS)
    if len(names) > core:
        spot = np.eye(CLASSES)[label[:core]]
        label, _ = _head_assigned(seqs, None, label, core, spot.T @ pairs @ spot)
        label[label < 0] = 0
    label, other, grid = _swept(seqs, pairs, label)
    sent = spark.sparkContext.broadcast(dict(zip(names, label.tolist(), strict=True)))

    def numbered(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            k = np.fromiter(map(sent.value.get, words, repeat(-1)), np.int64, len(words))
            first, second = names_of(words)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers_of(first)), pa.array(first), pa.array(second), pa.array(k, mask=k < 0)], ["word", "c", "u", "h", "h2", "_own"])

    counted, known = vocabulary, other.select(F.col("u").alias("_u"), F.col("k").alias("_other"))
    words = vocabulary.select("word", "c").mapInArrow(numbered, "word binary, c long, u long, h long, h2 int, _own long")
    words = words.join(known, F.col("u") == F.col("_u"), "left").withColumn("_k", F.coalesce("_own", "_other"))
    words = settle(words.select("word", "c", "h", "h2", F.col("h2").bitwiseAND(F.lit(ENDINGS - 1)).alias("e"), F.col("_k").cast("int").alias("k")))
    discard(counted, other)
    # The class of an ending: that of most words seen once or twice with it; of endings not seen, the class of most such words.
    kinds = words.where("k is not null and c <= 2").groupBy("e", "k").agg(F.count(F.lit(1)).alias("n"))
    by_ending = {r["e"]: r["k"] for r in kinds.groupBy("e").agg(F.max_by("k", F.struct("n", -F.col("k"))).alias("k")).collect()}  # ENDINGS rows at most
    usual = kinds.groupBy("k").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "k").first()
    endings = np.array([by_ending.get(e, usual["k"] if usual else 0) for e in range(ENDINGS)], np.int64)
    vocabulary = words.withColumn("k", F.coalesce("k", F.lit(endings)[F.col("e")].cast("int"))).drop("e")
    share = (grid.sum(0) + 1) / (grid.sum() + CLASSES)
    moves = np.log10((grid + CLASSES * share[None, :]) / (grid.sum(1, keepdims=True) + CLASSES))
    one = lambda n: F.sum((F.col("c") == n).cast("long"))
    rows = vocabulary.groupBy("k").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), one(1).alias("n1"), one(2).alias("n2")).collect()  # CLASSES rows at most
    size, off, unseen = np.ones(CLASSES), np.full(CLASSES, 0.5), np.full(CLASSES, 0.5)
    for r in rows:
        off[r["k"]] = min(0.95, max(0.05, r["n1"] / max(1, r["n1"] + 2 * r["n2"])))
        size[r["k"]], unseen[r["k"]] = r["n"], off[r["k"]] * r["v"] / r["n"]
    units = np.concatenate([label[:core], np.zeros(WORDS - core, np.int64), endings])
    return {
        "vocabulary": vocabulary,
        "head": head,
        "classes": dict(zip(names, label.tolist(), strict=True)),
        "unit": {w: k for k, w in enumerate(names[:core])},
        "label": units,
        "moves": moves,
        "size": size,
        "off": off,
        "unseen": np.log10(unseen),
        "total": total,
        "types": types,
    }


def _numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, text): row tells rows apart, once they are settled."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score): one row for each row of docs; a null text is empty, repeated rows and null ids keep their rows, other columns are ignored, and an empty table gives no rows.

    Words of the head are scored where the text is read; the others meet their counts and classes in a join, by 87 bits of
    hashes, and are summed by row.
    """
    head = model["head"] if END in model["head"] else {END: 0} | model["head"]
    head = {END: head[END]} | head
    with sparing(docs.sparkSession):
        seqs = settle(sequences(_numbered(docs, id_col, text_col), head))
    return _scored(seqs, model | {"head": head})


def _scored(seqs: DataFrame, model: dict) -> DataFrame:
    spark, names = seqs.sparkSession, list(model["head"])
    label = np.array([model["classes"].get(w, 0) for w in names], np.int64)
    c = np.array([model["head"][w] for w in names], np.float64)
    least = float(model["total"] + model["types"] + 1)
    word_score = np.where(c > 0, np.log10(np.maximum(c - model["off"][label], 1e-9) / model["size"][label]), model["unseen"][label])
    sent = spark.sparkContext.broadcast((label, c > 0, word_score, np.log10((c + 1) / least), model["moves"]))  # HEAD numbers at most
    columns, beside = seqs.select("ids", "rare", "rare2", "doc_id", "row"), CLASSES + 1

    def read(b: pa.RecordBatch):
        """Classes of the tokens of a batch and of those before them (-1 outside the head), their numbers, and each token's row."""
        ids, sizes = _unpacked(b.column(0), np.int32)
        k = np.where(ids >= 0, label[np.maximum(ids, 0)], -1)
        return k, np.concatenate((label[:1], k[:-1])), ids, np.repeat(np.arange(b.num_rows), sizes), sizes

    def near_run(batches):
        _, known, word_score, base, moves = sent.value
        for b in batches:
            k, before, ids, row, sizes = read(b)
            value = np.where(ids >= 0, word_score[np.maximum(ids, 0)], 0.0)
            both = (k >= 0) & (before >= 0)
            value[both] += moves[before[both], k[both]]
            add = lambda x: np.bincount(row, weights=np.where(ids >= 0, x[np.maximum(ids, 0)], 0), minlength=b.num_rows)  # noqa: B023, E731
            score = np.bincount(row, weights=value, minlength=b.num_rows)
            arrays = [pa.array(sizes.astype(np.int64)), pa.array(add(known).astype(np.int64)), pa.array(add(base)), pa.array(score)]
            yield pa.RecordBatch.from_arrays([b.column(4), b.column(3), *arrays], ["row", "doc_id", *sums])

    def rare_run(batches, pairs):
        for b in batches:
            k, before, ids, row, _ = read(b)
            at = np.flatnonzero(ids < 0)  # the last token of a text is the end token: each of these has a next one
            if not len(at):
                continue
            h, h2, row = _unpacked(b.column(1), np.int64)[0], _unpacked(b.column(2), np.int32)[0].astype(np.int64), b.column(4).to_numpy()[row[at]]
            after = np.append(k, 0)[at + 1]
            if pairs:  # two in a row, whose classes meet once both are known
                follows = np.flatnonzero(after < 0)
                found = {"row": row[follows], "h": h[follows], "h2": h2[follows], "g": h[follows + 1], "g2": h2[follows + 1]}
            else:  # classes before and behind, from 1 on, 0 where they are not known here, share a number with the second part of the name
                found = {"row": row, "h": h, "x": h2 << 32 | (before[at] + 1) * beside + after + 1}
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.values()], list(found))

    sums = ("n_tokens", "n_known", "base", "score")
    near = columns.mapInArrow(near_run, "row long, doc_id long, n_tokens long, n_known long, base double, score double")
    single = columns.mapInArrow(lambda batches: rare_run(batches, False), "row long, h long, x long")
    pairs = columns.mapInArrow(lambda batches: rare_run(batches, True), "row long, h long, h2 long, g long, g2 long")
    # Count and class in one number, and names under one pair of names: all joins share one exchange of the vocabulary.
    vocabulary, moves = model["vocabulary"].select(F.col("h").alias("w"), F.col("h2").cast("long").alias("w2"), (F.col("c") * CLASSES + F.col("k")).alias("ck")), F.lit(model["moves"].ravel())
    of = lambda values, at: F.lit(np.asarray(values))[at]
    unseen = lambda second: of(model["label"][WORDS:], second.bitwiseAND(F.lit(ENDINGS - 1))).cast("int")

    def told(df, first, second, k, c=None):
        """df with class k, and count c, of the words named first and second."""
        df = df.join(vocabulary, (F.col(first) == F.col("w")) & (F.col(second) == F.col("w2")), "left")
        df = df if c is None else df.withColumn(c, F.coalesce(F.expr(f"ck div {CLASSES}"), zero))
        return df.withColumn(k, F.coalesce(F.pmod("ck", F.lit(CLASSES)).cast("int"), unseen(F.col(second)))).drop("w", "w2", "ck")

    none, zero, k = F.lit(0.0), F.lit(0).cast("long"), F.col("k")
    pairs = told(told(pairs, "h", "h2", "k"), "g", "g2", "_k")
    pairs = pairs.select("row", zero.alias("n_known"), none.alias("base"), moves[k * CLASSES + F.col("_k")].alias("score"))
    ab = F.col("x").bitwiseAND(F.lit(0xFFFFFFFF))
    single = single.select("row", "h", F.shiftright("x", 32).alias("h2"), F.floor(ab / beside).alias("a"), (ab % beside).alias("b"))
    single = told(single, "h", "h2", "k", "c")
    value = F.when(F.col("a") > 0, moves[(F.col("a") - 1) * CLASSES + k]).otherwise(none) + F.when(F.col("b") > 0, moves[k * CLASSES + F.col("b") - 1]).otherwise(none)
    value = value + F.when(F.col("c") > 0, F.log10((F.col("c") - of(model["off"], k)) / of(model["size"], k))).otherwise(of(model["unseen"], k))
    single = single.select("row", (F.col("c") > 0).cast("long").alias("n_known"), F.log10((F.col("c") + 1) / F.lit(least)).alias("base"), value.alias("score"))
    added = single.union(pairs).select("row", F.lit(None).cast("long").alias("doc_id"), zero.alias("n_tokens"), "n_known", "base", "score")
    out = near.union(added).groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in sums])
    return out.select("doc_id", "n_tokens", "n_known", F.col("base").alias("base_score"), "score")


def result(docs: DataFrame) -> DataFrame:
    """The contract's columns: ids whose crc32 modulo 7 is 2 are held out; a null id is not. Texts are tokenised for the counts, and once more into numbers for training and scoring."""
    held = remainder("doc_id", 7) == 2
    with sparing(docs.sparkSession):
        vocabulary = settle(counts(docs.where(~held).select("text")))
        head = top_words(vocabulary)
        seqs = settle(sequences(_numbered(docs).withColumn("held", held), head))
        model = _fitted(vocabulary, head, seqs.where("not held"))
    out = _scored(seqs, model)
    return out.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model["total"]).cast("long").alias("train_tokens"), "base_score", "score")
