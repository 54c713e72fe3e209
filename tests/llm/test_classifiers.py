"""Scores of the two classifiers against brute force, and what their methods are for."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from test_llm import DOCS, LABELS

from mediasieve.llm import quality, toxicity


def insult_and_group(n=1500, seed=3):
    """Toxic is an insult together with a group; either alone, even several of it, is not."""
    rng = random.Random(seed)
    plain, insults, groups = [f"{a}{b}word" for a in "abcdefghij" for b in "klmnopqrstabcdefghij"], [f"{k}zinsult" for k in "abcd"], [f"{k}qgroup" for k in "abcd"]
    docs, labels = [], []
    for i in range(n):
        kind = i % 4
        words = rng.choices(plain, k=40)
        words += rng.sample(insults, rng.randrange(1, 4)) if kind & 1 else []
        words += rng.sample(groups, rng.randrange(1, 4)) if kind & 2 else []
        rng.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(kind == 3)))
    return docs, labels


def test_insult_with_group(spark):
    docs, labels = insult_and_group()
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(df, lab)
    got = {r["doc_id"]: r for r in toxicity.result(df, lab).collect()}
    held = [i for i, *_ in docs if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == (i % 4 == 3) for i in held) / len(held) > 0.97
    # Not by linear weights alone: two insults without a group weigh more than one, and stay clean.
    at = lambda w: model["index"][toxicity.buckets(w)[0]]
    inner = model["v"][[at(f"{k}zinsult") for k in "abcd"]] @ model["v"][[at(f"{k}qgroup") for k in "abcd"]].T
    assert inner.mean() > 0.5


def test_toxicity_scores_equal_brute_force(spark):
    docs, labels = insult_and_group(600)
    docs += [(9000, None, "en", "s", 1), (9001, "", "en", "s", 1), (9002, "azinsult! BQGROUP unseen", "en", "s", 1)]
    df, lab = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    m = toxicity.train(df, lab)
    for r in toxicity.scored(df, m).join(df.select("doc_id", "text"), "doc_id").collect():
        words = set(toxicity._WORD.findall((r["text"] or "").lower()))
        at = sorted({m["index"][b] for w in words for b in toxicity.buckets(w) if b in m["index"]})
        z = m["bias"] + sum(m["w"][i] for i in at) + sum(float(m["v"][i] @ m["v"][j]) for k, i in enumerate(at) for j in at[:k])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


def test_every_term_that_tells_has_weights(spark):
    """No number of terms is a bound: 2000 telling words all get one."""
    rng = random.Random(0)
    words = ["".join(x) for x in itertools.product("abcdefghij", "klmnopqrst", "abcde", "uvwx")]
    docs = [(i, " ".join(rng.sample(words, 800) if i % 2 else ["plain", "words"]), "en", "s", 1) for i in range(400)]
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, 1, i % 2) for i in range(400)], LABELS)
    assert len(set(toxicity.train(df, lab)["index"]) & {toxicity.buckets(w)[0] for w in words}) > 1990


def test_quality_equals_brute_force(spark):
    rng = random.Random(5)
    good, bad = ["house", "river", "stood", "there", "small"], ["click", "win", "cheap", "now", "prize"]
    rows, labels = [], []
    for i in range(500):
        y = int(rng.random() < (0.9 if i % 5 else 0.2))
        text = " ".join(rng.choices(good if y else bad, k=30) + rng.choices(["and", "the", "of"], k=10))
        rows.append((i, None if i == 499 else text, rng.choice(["en", "de"]), f"s{i % 5}" if i % 50 else None, 1))
        if i % 3:
            labels.append((i, y, 0))
    df, lab = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    m = quality.train(df, lab)
    p = {r[0]: min(max(float(quality.probabilities([r[1]], m)[0]), 1e-4), 1 - 1e-4) for r in rows}
    y = {i: q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5}
    s = {i: float(y.get(i, p[i])) for i in p}
    site = {r[0]: (r[3], r[2]) for r in rows}
    mean = sum(s.values()) / len(s)
    within = max(sum((x - mean) ** 2 for x in s.values()) / len(s), 1e-6)

    def strength(groups):
        n, k = sum(g[0] for g in groups), len(groups)
        spread = sum(g[0] * (g[1] / g[0] - mean) ** 2 for g in groups)
        return min(500.0, max(5.0, within / max((spread - (k - 1) * within) / n, 1e-9)))

    hosts, paths = collections.defaultdict(lambda: [0, 0.0]), collections.defaultdict(lambda: [0, 0.0])
    for i, (h, c) in site.items():
        for g in (hosts[h], paths[h, c]):
            g[0] += 1
            g[1] += s[i]
    sh, sp = strength(list(hosts.values())), strength(list(paths.values()))
    logit = lambda x: math.log(x / (1 - x))
    got = quality.judged(df, lab).collect()
    assert len(got) == 500 and "y" not in got[0].asDict()
    for r in got:
        i = r["doc_id"]
        (n, t), (hn, ht) = paths[site[i]], hosts[site[i][0]]
        host = (ht - s[i] + sh * mean) / (hn - 1 + sh)
        path = (t - s[i] + sp * host) / (n - 1 + sp)
        odds = logit(p[i]) + logit(min(max(path, 1e-4), 1 - 1e-4)) - logit(mean)
        assert (r["p"], r["host_posterior"], r["path_posterior"], r["posterior"]) == pytest.approx((p[i], host, path, 1 / (1 + math.exp(-odds))), abs=1e-6)
        assert r["keep"] == (r["posterior"] >= quality.KEEP_AT)
    held = [i for i, q, _ in labels if i not in y and i != 499]
    truth = {i: q for i, q, _ in labels}
    keep = {r["doc_id"]: r["keep"] for r in got}
    assert np.mean([keep[i] == bool(truth[i]) for i in held]) > 0.95


def test_words_are_evidence_that_shape_is_not(spark):
    """Texts of one shape are told apart by their words alone."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["aaab", "aaba", "abaa"] if i % 2 else ["baab", "abba", "bbab"], k=25)), "en", "s", 1) for i in range(300)]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2, 0) for i in range(300)], LABELS)
    got = quality.judged(df, lab).collect()
    assert all(r["keep"] == bool(r["doc_id"] % 2) for r in got)
