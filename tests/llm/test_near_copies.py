"""Near copies against brute force."""

import random

from test_llm import DOCS, ascii_lower, rows_of, text_of, union

from mediasieve.llm import near_copies


def test_near_copies(spark):
    rng = random.Random(5)
    rows = [r[:2] for r in rows_of()[0]] + [(None, "and no id here"), (None, "and no id here")]
    # Copies with a few words changed: over 4 bits apart, and far more members than one star links.
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for i in range(60):
        words = base[:]
        for at in rng.sample(range(300), rng.choice([2, 3, 4, 5, 8])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(words)))
    words = [ascii_lower(text_of(t)).split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(min(1, len(w)), len(w) - 4))} for w in words]
    alike = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    label = union(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j])])
    want = {}
    for (i, _), c in zip(rows, label, strict=True):
        want[c] = min(want.get(c, (True, 0)), (i is None, i or 0))
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS).repartition(5)
    got = near_copies.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == sorted(want.values())
    assert near_copies.keep_one(df.limit(0)).count() == 0


def test_pipeline_drops_copies_beyond_four_bits(spark):
    import corpus_pipeline

    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(0, " ".join(base), "en", "s", 1)] + [(1 + i, " ".join([*base[: 10 * i], f"x{i}", *base[10 * i + 1 :]]), "en", "s", 1) for i in range(1, 9)]
    docs = spark.createDataFrame(rows, DOCS)
    assert [r["doc_id"] for r in corpus_pipeline.deduplicate(spark, docs, "").collect()] == [0]


def test_pipeline_joins_simhash_links(spark):
    """Texts that SimHash links though their shingles as sets differ; one is alike to a text that only shingles link."""
    import corpus_pipeline

    from mediasieve.llm.simhash_dedup import fingerprint

    rng = random.Random(3)
    common = [f"w{rng.randrange(10**6)}" for _ in range(40)] * 20
    texts = [[*common, *[f"v{rng.randrange(10**6)}" for _ in range(30)]] for _ in range(4)]
    bits = [fingerprint(" ".join(w).encode()) for w in texts]
    assert all((bits[0] ^ x).bit_count() <= 4 for x in bits)
    far = [f"u{rng.randrange(10**6)}" for _ in range(30)]
    rows = [(i + 5, " ".join(w)) for i, w in enumerate(texts)] + [(3, " ".join([*texts[2], "more", "words"])), (1, " ".join(far)), (9, None), (2, " ")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS).repartition(3)
    got = corpus_pipeline.deduplicate(spark, docs, "")
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 2, 3]
    assert corpus_pipeline.deduplicate(spark, docs.limit(0), "").count() == 0


def test_buckets_in_blocks(spark, monkeypatch):
    """A chain of copies that no star connects, and unlike texts with one passage, whole or dealt out in blocks, by brute force."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(rng.randrange(10, 40))] + passage)) for i in range(60)]
    base = [word() for _ in range(120)]
    for i in range(30):
        rows.append((100 + i, " ".join(base)))
        base = base[:3] + base[5:] + [word(), word()] if i % 3 else [*base[2:], word(), word()]
    words = [t.split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]
    label = union(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])])
    want = sorted({c: i for (i, _), c in reversed(list(zip(rows, label, strict=True)))}.values())
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS).repartition(4)
    for shingles in (near_copies.CELL_SHINGLES, 600):
        monkeypatch.setattr(near_copies, "CELL_SHINGLES", shingles)
        assert sorted(r["doc_id"] for r in near_copies.keep_one(df).collect()) == want


def test_linked_connects_what_is_alike():
    import numpy as np

    a = np.arange(100)
    grams = [a, a + 5, a + 10, a + 500, np.concatenate([a[:50], a[:50] + 1000])]
    assert near_copies.linked([1, 2, 3, 4, 5], grams) == [(0, 1), (0, 2)]
    assert near_copies.linked([1, 1, 3, 4, 5], grams) == [(0, 2)] and near_copies.linked([7, 7], grams[:2]) == []
