"""The class model against brute force: scores, classes of rare words, ties at the head's bound."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from mediasieve import storage
from mediasieve.llm import brown_lm


def model_of(spark, monkeypatch, texts, words, head):
    monkeypatch.setattr(brown_lm, "WORDS", words)
    monkeypatch.setattr(brown_lm, "HEAD", head)
    return brown_lm.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))


def alternating(n=600, kinds=3, each=40, seed=0):
    """Texts in which a word of one kind follows one of the kind before; few words of a kind are frequent."""
    rng = random.Random(seed)
    weight = [1 / (k + 1) for k in range(each)]
    return [" ".join(f"{'abc'[(i + k) % kinds]}{rng.choices(range(each), weight)[0]}" for k in range(12)) for i in range(n)]


@pytest.mark.parametrize("words,head", [(12, 30), (200, 1000), (5, 5)])
def test_scores_equal_brute_force(spark, monkeypatch, words, head):
    texts = alternating() + ["", None]
    m = model_of(spark, monkeypatch, texts, words, head)
    assert len(m["head"]) == min(head, len({w for t in texts for w in (t or "").split()}) + 1)
    known = {bytes(r["word"]): (r["c"], r["k"]) for r in m["vocabulary"].collect()}
    assert {w: m["classes"][w] for w in m["head"]} == {w: known[w][1] for w in m["head"]}
    other = [*texts[::50], "a0 New b39 c39 a38 unseen unseen", None, "x\ty", "c39 c38 b37 b39"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(other)] + [(1, other[1]), (None, "a1 b39 zz")], "doc_id long, text string").repartition(2)
    got = collections.defaultdict(list)
    for r in brown_lm.scored(docs, m).collect():
        got[r["doc_id"]].append(r)
    for i, t in [*enumerate(other), (None, "a1 b39 zz")]:
        before, score, base, hits = m["classes"][brown_lm.END], 0.0, 0.0, 0
        for w in brown_lm.tokens(None if t is None else t.encode()):
            c, k = known.get(w, (0, m["label"][words + brown_lm.ending(w)]))
            score += m["moves"][before, k] + (np.log10((c - m["off"][k]) / m["size"][k]) if c else m["unseen"][k])
            base += np.log10((c + 1) / (m["total"] + m["types"] + 1))
            before, hits = k, hits + (c > 0)
        assert len(got[i]) == (2 if i == 1 else 1)
        for r in got[i]:
            assert (r["n_known"], r["score"], r["base_score"]) == (hits, pytest.approx(score), pytest.approx(base))


def test_rare_words_find_their_class(spark, monkeypatch):
    """Words outside the head, and those that exchange doesn't move, go where their neighbours say."""
    monkeypatch.setattr(brown_lm, "CLASSES", 4)
    m = model_of(spark, monkeypatch, alternating(1500), 16, 40)
    by = collections.defaultdict(collections.Counter)
    for r in m["vocabulary"].collect():
        if r["word"]:
            by[bytes(r["word"])[:1]][r["k"]] += r["c"]
    usual = [c.most_common(1)[0] for c in by.values()]
    assert len({k for k, _ in usual}) == 3
    assert all(n >= 0.9 * sum(c.values()) for (_, n), c in zip(usual, by.values(), strict=True))


def test_class_pairs_cover_all_tokens(spark, monkeypatch):
    """Transitions are counted over all training text, rare words included, but for two rare words in a row."""
    texts = alternating(100)
    m = model_of(spark, monkeypatch, texts, 12, 30)
    assert m["total"] == sum(len(t.split()) + 1 for t in texts)
    assert (10 ** m["moves"]).sum(1) == pytest.approx(np.ones(brown_lm.CLASSES))


def test_a_flat_vocabulary_keeps_its_units(spark):
    df = spark.range(200_000).selectExpr("CAST(concat('w', id) AS BINARY) AS word", "1L AS c")
    head = brown_lm.top_words(df)
    assert len(head) == brown_lm.HEAD and list(head)[:3] == [b"", b"w0", b"w1"] and head[b""] == 0
    few = spark.createDataFrame([(bytearray(w.encode()), c) for w, c in (("", 5), ("b", 9), ("a", 9), ("d", 3), ("c", 3), ("e", 3), ("f", 1))], "word binary, c long")
    assert [list(brown_lm.top_words(few, n)) for n in (1, 2, 5, 9)] == [[b""], [b"", b"a"], [b"", b"a", b"b", b"c", b"d"], [b"", b"a", b"b", b"c", b"d", b"e", b"f"]]


def test_best_class_is_the_likeliest():
    """Against the likelihood of the class bigrams, computed anew for each class."""
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 60, (5, 5)).astype(float)
    f = lambda g: brown_lm._f(g).sum() - brown_lm._f(g.sum(1)).sum() - brown_lm._f(g.sum(0)).sum()
    for _ in range(40):
        slot = np.sort(rng.choice(10, rng.integers(1, 10), replace=False))
        n = rng.integers(1, 40, len(slot))
        value = []
        for k in range(5):
            g = grid.copy()
            for s, x in zip(slot, n, strict=True):
                g[(k, s) if s < 5 else (s - 5, k)] += x
            value.append(f(g))
        got = brown_lm.best_class(np.array([0]), slot, n, grid)[0]
        assert value[got] == pytest.approx(max(value))


def chained(n=300, seed=4):
    """Texts in which most words are rare and stand among rare ones: what they follow tells their kind."""
    rng = random.Random(seed)
    return [" ".join(f"{'xyz'[(i + k) % 3]}{rng.randrange(60)}" for k in range(15)) + " own own own" for i in range(n)]


@pytest.mark.parametrize("words,head", [(4, 10), (12, 30), (200, 1000)])
def test_no_class_pair_is_left_out(spark, monkeypatch, words, head):
    """Counts of class bigrams by brute force, whichever words are rare."""
    texts = [*alternating(150), *chained(50), "", None]
    m = model_of(spark, monkeypatch, texts, words, head)
    known, size = {bytes(r["word"]): r["k"] for r in m["vocabulary"].collect()}, brown_lm.CLASSES
    grid = np.zeros((size, size))
    for t in texts:
        k = [known[w] for w in (brown_lm.END, *brown_lm.tokens((t or "").encode()))]
        np.add.at(grid, (k[:-1], k[1:]), 1)
    share = (grid.sum(0) + 1) / (grid.sum() + size)
    assert m["moves"] == pytest.approx(np.log10((grid + size * share) / (grid.sum(1, keepdims=True) + size)))


def test_words_move_by_neighbours_outside_the_head(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "CLASSES", 4)
    monkeypatch.setattr(brown_lm, "SWEEPS", 8)
    m = model_of(spark, monkeypatch, [t.removesuffix(" own own own") for t in chained()], 8, 16)
    by = collections.defaultdict(collections.Counter)
    for r in m["vocabulary"].collect():
        by[bytes(r["word"])[:1]][r["k"]] += r["c"]
    del by[b""]
    usual = [c.most_common(1)[0] for c in by.values()]
    assert len({k for k, _ in usual}) == 3
    assert all(n >= 0.9 * sum(c.values()) for (_, n), c in zip(usual, by.values(), strict=True))


def test_best_move_is_the_likeliest():
    """Against the likelihood computed anew, of words that the counts hold already."""
    rng = np.random.default_rng(7)
    label = rng.integers(0, 4, 30)
    text = rng.integers(0, 30, 900) * rng.integers(0, 2, 900)
    pairs = np.zeros((30, 30))
    np.add.at(pairs, (text[:-1], text[1:]), 1)

    def counted(label):
        spot = np.eye(4)[label]
        return spot.T @ pairs @ spot

    rows = []
    for u in range(30):
        seen = np.zeros(9)
        np.add.at(seen, np.append(label, label + 4), np.append(pairs[u], pairs[:, u]))
        seen[[label[u], 4 + label[u]]] -= pairs[u, u]
        seen[8] = pairs[u, u]
        rows += [(u, s, n) for s, n in enumerate(seen.astype(int)) if n]
    u, slot, n = np.array(rows).T
    got = brown_lm.best_move(brown_lm._starts(u), slot, n, label[np.unique(u)], counted(label))
    for u, k in zip(np.unique(u), got, strict=True):
        value = [brown_lm.likelihood(counted(np.where(np.arange(30) == u, c, label))) for c in range(4)]
        assert value[k] == pytest.approx(max(value), abs=1e-2)
    same = lambda label: brown_lm.exchange(pairs[:9, :9], 4, 1, (label[:9], outside(label), counted(label)))

    def outside(label):
        spot = np.eye(4)[label[9:]]
        return np.hstack([pairs[:9, 9:] @ spot, pairs[9:, :9].T @ spot])

    moved = np.append(same(label), label[9:])
    assert brown_lm.likelihood(counted(moved)) > brown_lm.likelihood(counted(label))


def test_what_is_used_up_leaves_the_disk(spark, tmp_path, monkeypatch):
    """Of the tables written only those that the result reads stay, it stays readable, and its joins share one exchange of the vocabulary; settings are as before."""
    texts = [*alternating(150), *chained(50), "", None, None]
    docs = spark.createDataFrame([(k % 190, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled",)
    before = [spark.conf.get(k, None) for k in names]
    monkeypatch.setattr(storage, "shared_dir", lambda spark: f"file://{tmp_path}/a b")
    monkeypatch.setattr(brown_lm, "WORDS", 8)
    monkeypatch.setattr(brown_lm, "HEAD", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = brown_lm.result(docs)
        read = {f.rpartition("/")[0].rpartition("/")[2] for f in out.inputFiles()}
        assert len(read) == 2 and {p.name for p in (tmp_path / "a b").iterdir()} == read
        first = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        assert len(first) == len(texts) and plan.count("ReusedExchange") == 2
        rounded = lambda rows: sorted(repr([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)
        assert rounded(out.collect()) == rounded(first)
        assert [spark.conf.get(k, None) for k in names] == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_of_frequent_words_are_spread(spark, monkeypatch):
    """Classes don't depend on how many words' counts meet in a task, those of the first words included."""
    found = []
    for part in (2, 128):
        monkeypatch.setattr(brown_lm, "_PART", part)
        m = model_of(spark, monkeypatch, [*alternating(150), *chained(50), "", None], 5, 30)
        found.append((m["classes"], {bytes(r["word"]): r["k"] for r in m["vocabulary"].collect()}))
    assert found[0] == found[1]
    keys, n = np.array([1, 3, 8, 11, 12, 30]), np.array([5, 1, 2, 9, 4, 7])
    got = []
    for part, steps, c in zip(*[x.to_pylist() for x in brown_lm._dealt(keys, n, 4).columns], strict=True):
        got += zip((part * 4 + np.cumsum(np.frombuffer(steps, np.int32))).tolist(), np.frombuffer(c, np.int32).tolist(), strict=True)
    assert got == list(zip(keys.tolist(), n.tolist(), strict=True))


def test_split_gives_the_tokens():
    rng = random.Random(2)
    texts = [None, b"", b" ", b"\xff\x00 A\x0bB\xc3\x84 ", *(bytes(rng.choices([*range(32), 32, 32, 65, 97, 0x85, 0xA0, 0xC3, 0xE2], k=40)) for _ in range(200))]
    for some in (pa.array(texts, pa.binary()), pa.array(texts, pa.binary()).slice(1, 90), pa.array([], pa.binary())):
        words, sizes = brown_lm._split(some)
        want = [brown_lm.tokens(t)[:-1] for t in some.to_pylist()]
        assert sizes.tolist() == [len(w) for w in want] and words.to_pylist() == [x for w in want for x in w]
