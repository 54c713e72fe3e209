"""The training-data operators against brute force, on awkward rows and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mediasieve.llm import brown_lm, decontaminate, html_text, media, mix_sources, quality, queries, shard, simhash_dedup, toxicity, url_filter
from mediasieve.llm.common import table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def rows_of(seed=0, n=120):
    """Documents with copies, near copies, shared passages, nulls, empties, a long one and a hot source."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "the of Und él ñu bra kor zet".split() for b in ["", "a", "ión,", "ß", "X", "77"]]
    passage = " ".join(rng.choices(vocabulary, k=30))
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 4, 5, 20, 60, 200]))
        if i % 9 == 0:
            words = words[:5] + passage.split() + words[5:]
        text = rng.choice([" ", "\n", "\t "]).join(words)
        if i % 7 == 3 and out:
            text = rng.choice(out)[1]
        if i % 7 == 5 and out and out[-1][1]:
            text = out[-1][1] + " Tail"
        out.append((i, None if i % 31 == 30 else text, rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{i % 4}" if i % 17 else None, 1))
    out.append((n, " ".join(rng.choices(vocabulary, k=30_000)), "en", "hot", 1))
    out.append((None, "no id here at all", "en", "s1", 1))
    out += [out[4], out[4]]
    return out, passage


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of()[0], DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def text_of(x):
    return "" if x is None else x


def ascii_lower(x):
    return x.translate({c: c + 32 for c in range(65, 91)})


def size_of(x):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text_of(x)))


# 1. Mixing


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in capped]
        share = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in left) if left else 0
        over = {s for s in left if weight[s] * share > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else weight[s] * share for s in names}
        capped |= over


@pytest.mark.parametrize("leaf,fan", [(4096, 64), (8, 2)])
def test_mix(docs, monkeypatch, leaf, fan):
    monkeypatch.setattr(mix_sources, "LEAF_DOCS", leaf)
    monkeypatch.setattr(mix_sources, "FAN_IN", fan)
    rows, _ = rows_of()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    want = targets(dict(sizes))
    got = mix_sources.mixed(docs).collect()
    assert sorted(map(repr, ((r["doc_id"], r["source"], r["size"]) for r in got))) == sorted(map(repr, ((r[0], r[3], size_of(r[1])) for r in rows)))
    taken = collections.Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    largest = {s: max(size_of(r[1]) for r in rows if r[3] == s) for s in want}
    for s, t in want.items():
        # No whole copies come nearer than half of a document that outweighs the rest of its source.
        assert abs(taken[s] - t) <= 0.02 * t + 10 + max(0, 2 * largest[s] - sizes[s]) / 2
    again = mix_sources.mixed(docs.repartition(3)).collect()
    key = lambda r: repr((r["doc_id"], r["text_hash"], r["copies"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    result = mix_sources.result(docs)
    assert set(result.columns) >= {"doc_id", "size", "source_size", "target", "taken"}


def test_pivot_keeps_sums_and_expectations():
    rng = np.random.default_rng(0)
    size, total = rng.integers(1, 50, 40).astype(float), np.zeros(40)
    for seed in range(3000):
        part, at = mix_sources.pivot(size, np.full(40, 0.3), seed)
        open_ = [k for k in range(40) if 1e-9 < part[k] < 1 - 1e-9]
        assert open_ in ([], [at]) and (part * size).sum() == pytest.approx(0.3 * size.sum())
        total += part
    assert np.abs(total / 3000 - 0.3).max() < 0.06


def test_take(docs, empty):
    found = mix_sources.mixed(docs)
    got = mix_sources.take(docs.withColumn("_times", F.lit(7)))
    assert got.columns == [*docs.columns, "_times"] and got.count() == found.agg(F.sum("copies")).first()[0]
    want = {(r["doc_id"], r["text_hash"]): r["n"] for r in found.groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    have = {(r["doc_id"], r["h"]): r["n"] for r in got.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert have == want
    assert mix_sources.mixed(empty).count() == 0 == mix_sources.take(empty).count()


# 2. SimHash


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text_of(text)))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def union(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return [find(x) for x in range(n)]


def brute_components(fps, radius=4):
    return union(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius])


def test_simhash_query(docs, empty):
    rows, _ = rows_of()
    fps = [simhash(r[1]) for r in rows]
    label = brute_components(fps)
    least = {}
    for r, c in zip(rows, label, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(map(repr, ((r[0], f"{fp:016x}", least.get(c)) for r, fp, c in zip(rows, fps, label, strict=True))))
    got = simhash_dedup.result(docs.withColumn("fp", F.lit("x"))).collect()
    assert sorted(map(repr, ((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got))) == want
    assert simhash_dedup.result(empty).count() == 0
    kept = simhash_dedup.keep_one(docs.withColumn("_hash", F.lit(1)))
    assert kept.count() == len(set(label)) and kept.columns == [*docs.columns, "_hash"]
    assert simhash_dedup.keep_one(empty).count() == 0


@pytest.mark.parametrize("bands", [simhash_dedup.BANDS, simhash_dedup.WIDE_BANDS])
@pytest.mark.parametrize("cell_points", [simhash_dedup.CELL_POINTS, 12])
def test_links_lose_nothing(spark, bands, cell_points):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for x in list(fps)[:60]:
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5, 6])):
                y ^= 1 << b
            fps.add(y)
    fps |= {sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(80)}  # a tight group
    fps = sorted(fps)
    label = brute_components(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    at = {x: k for k, x in enumerate(signed)}
    found = [(at[r["a"]], at[r["b"]]) for r in simhash_dedup.links(df, bands=bands, cell_points=cell_points).collect()]
    assert union(len(fps), found) == label


def test_linked_in_large_cells():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base[:200] ^ (np.uint64(1) << rng.integers(0, 60, 200).astype(np.uint64)), *[base[:3] ^ np.uint64(1 << k) for k in range(60)], rng.integers(0, 1 << 63, 1000, dtype=np.uint64)]))
    own = rng.random(len(fps)) < 0.8
    assert own.sum() * len(fps) > 1 << 20
    near = [(i, j) for i in np.flatnonzero(own).tolist() for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4).tolist() if i != j]
    a, b = simhash_dedup._linked(fps, own, 4)
    assert union(len(fps), list(zip(a.tolist(), b.tolist(), strict=True))) == union(len(fps), near)


# 3. Decontamination


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text_of(text)))


def contamination(rows, items):
    windows = []
    for item, text in items:
        w = bench_words(text)
        t = min(13, len(w))
        windows += [(str(item), tuple(w[i : i + t])) for i in range(len(w) - t + 1) if t]
    out = []
    for r in rows:
        w = bench_words(r[1])
        hit, found = set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("block_rows", [decontaminate.BLOCK_ROWS, 20])
def test_decontamination(spark, docs, block_rows):
    rows, passage = rows_of()
    rows = [r for r in rows if r[0] != 120]  # the long text is too much for brute force
    p = passage.split()
    items = [(1, passage), (10, passage.upper()), (2, " ".join(p[:13])), (3, " ".join(p[3:10])), (4, "Und"), (5, ""), (6, None), (7, " ".join(p[5:18]) + " unlike " + " ".join(p[:14])), (8, "ñu ñua"), (1, passage)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(rows, DOCS).repartition(4).withColumn("w", F.lit("clash"))
    got = decontaminate.judged(df, bench, block_rows=block_rows).drop("text_hash").collect()
    assert sorted(map(repr, map(tuple, got))) == contamination(rows, items)


def test_decontamination_empty(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.result(empty, none).count() == 0
    got = decontaminate.result(docs, none)
    assert got.count() == docs.count() and got.where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.clean(docs, none).count() == docs.count()


def test_clean_drops_only_contaminated(spark, docs):
    _, passage = rows_of()
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    bad = decontaminate.result(docs, bench).where("contaminated").count()
    assert bad and decontaminate.clean(docs, bench).count() == docs.count() - bad


def test_winnowing_keeps_few_and_misses_none(spark):
    rng = random.Random(1)
    w = [f"w{rng.randrange(40)}" for _ in range(400)]
    df = spark.createDataFrame([(0, w), (1, w[100:113])], "k int, w array<string>")
    got = {r["k"]: r["p"] for r in df.select("k", decontaminate.winnow(F.col("w"), 13).alias("p")).collect()}
    assert len(got[0]) < 0.3 * len(w)
    assert {x >> decontaminate._POS for x in got[1]} <= {x >> decontaminate._POS for x in got[0]} and len(got[1]) == 1


# 4. HTML

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="cookie-notice">We use cookies, sorry, really.</div>
<article><h1>Head &eacute;&#33;</h1><p>First   one,
 with <b>bold</b> words&nbsp;here.<p>Second<br>line &lt;3</p><div class="ad">Buy, buy, buy now!</div><ul><li>Item one</li><li>Item two</li></ul>
<ul><li><a href=x>More</a></li><li><a href=y>Even more</a></li></ul><table><tr><td>a</td><td>b</td></tr></table><section id="comments"><p>Nice, very nice, so nice post!</p></section></article>
<aside>Side, with, many, commas, in it</aside><form><p>Your name, please, thanks</p></form><footer>&copy; All, rights, reserved</footer></body></html>"""


def test_html():
    assert html_text.main_text(PAGE).split("\n") == ["Head é!", "First one, with bold words here.", "Second", "line <3", "Item one", "Item two", "a b"]
    assert html_text.main_text(None) == "" == html_text.main_text("")
    assert html_text.main_text("just  text") == "just text"
    body = "<p>" + "Long text, of some length, that scores. " * 5 + "</p>"
    plain = f"<body><div id=top><a href=1>One</a> <a href=2>Two</a></div><div id=main><h2>Title</h2>{body * 3}<p>End.</p></div><div class=sidebar>{body}</div>"
    got = html_text.main_text(plain).split("\n")
    assert got[0] == "Title" and got[-1] == "End." and len(got) == 5
    assert html_text.main_text("<article><p>cut &am") == "cut &am"
    assert html_text.main_text("<article><p>a<!-- x <p>no --> b</p></article>") == "a b"
    nested = "<div class='wrap with-sidebar'><div class='page sidebar-left'><article><div class='entry-header'><h1>H</h1></div><p>Body text, yes.</p><div class='entry-footer'>tags</div><div id=disqus_thread><article class=comment><p>Me, too, and more, more, more.</p></article></div></article></div><div class=sidebar><p>Other, other, other, other.</p></div></div>"
    assert html_text.main_text(nested) == "H\nBody text, yes."
    assert html_text.main_text("<div " * 3000 + "<p>x" + "<b>" * 3000 + "deep") != "boom"


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (1, "u", PAGE)], "page_id long, url string, html string").withColumn("_html", F.lit(0))
    got = html_text.extracted(df).collect()
    assert len(got) == 3 and [r["text"] for r in got if r["page_id"] == 2] == [""]
    assert html_text.result(df.limit(0)).count() == 0


# 5. URLs


def test_urls(spark):
    urls = ["https://A.Example.ORG/es/x?q#f", "http://example.org/en/174", "http://notexample.org/es/", "http://x.com/de/1", "http://com/fr/", "http://x.com", "http://x.net/?a://b/c", "no scheme", None, "://org/", "http://org:80/", "http://sub.example.org/en/2#x", "https://x.com?u=http://example.org/es/"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.result(df).collect()}
    want = {}
    for k, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (ascii_lower(m[1]), m[2]) if m else ("", "")
        fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[k] = (host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow")
    assert got == want and url_filter.result(df).count() == len(urls) + 1
    assert url_filter.result(df.limit(0)).count() == 0
    many = url_filter.judged(df, spark.createDataFrame([("block", "", ""), ("allow", None, "/")], "verdict string, host string, path string"))
    assert many.where("page_id = 8").first()["verdict"] == "block"


# 6. Quality


def labelled_rows():
    rng = random.Random(2)
    good = ["the", "house", "was", "near", "a", "small", "river", "and", "stood", "there"]
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(["spam!!"] * 60) if bad and i % 8 else "A | b | c | d" * 9 if bad else " ".join(rng.choices(good, k=60)) + f". Word{i}."
        docs.append((i, text, "en", f"s{i % 5}", 1))
        if i % 2 == 0 or bad:
            labels.append((i, int(not bad), 0))
    return docs, labels


def test_quality(spark, docs, empty):
    rows, labels = labelled_rows()
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0)], LABELS)
    got = {r["doc_id"]: r["keep"] for r in quality.result(df, lab).collect()}
    assert got == {i: i % 4 != 0 for i in range(400)}
    assert quality.accepted(df.withColumn("_bad_id", F.lit(1)), lab).count() == 300
    assert quality.result(empty, lab).count() == 0
    assert quality.result(docs, lab.limit(0)).count() == docs.count() == quality.accepted(docs, lab).unionByName(docs.limit(0)).count() + quality.judged(docs, lab).where("not keep").count()


def test_sites_are_shrunk(spark):
    rows = [(i, i, "big", "en", 0.9) for i in range(500)] + [(1000 + i, i, "bad", "en", 0.1) for i in range(200)] + [(2000, 0, "bad", "en", 0.5), (2001, 0, "big", "en", 0.5), (2002, 0, "new", None, 0.5), (2003, 0, None, None, 0.5)]
    got = {r["doc_id"]: r for r in quality.posteriors(spark.createDataFrame(rows, "doc_id long, text_hash long, host string, path string, p double")).collect()}
    assert len(got) == len(rows)
    assert got[2000]["posterior"] < got[2002]["posterior"] < got[2001]["posterior"]
    mean = sum(r[4] for r in rows) / len(rows)
    assert got[2002]["path_posterior"] == pytest.approx(mean) == got[2003]["path_posterior"]


# 7. Language model


def test_lm(spark, empty):
    rng = random.Random(4)
    a, b = [f"a{k}" for k in range(30)], [f"b{k}" for k in range(30)]
    rows = [(i, " ".join(rng.choices(a if i % 2 else b, k=20)), "x", "s", 1) for i in range(300)] + [(900, None, "x", "s", 1), (901, "Unseen A1", "x", "s", 1), (None, "a1 a2", "x", "s", 1), (7, "a3", "x", "s", 1), (7, "a3", "x", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).repartition(3)
    rest = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    tokens = lambda t: [*ascii_lower(text_of(t)).split(), ""]
    seen = collections.Counter(w for r in rows if rest(r[0]) != 2 for w in tokens(r[1]))
    n, v = sum(seen.values()), len(seen)
    got = brown_lm.result(df).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"], r["n_tokens"]].append(r)
    for i, text, *_ in rows:
        t = tokens(text)
        r = by[i, len(t)].pop()
        assert r["held_out"] == (rest(i) == 2) and r["train_tokens"] == n and r["n_known"] == sum(seen[w] > 0 for w in t)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t))
    held = [r for r in got if r["held_out"] and r["n_tokens"] == 21]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert brown_lm.result(empty).count() == 0


def test_lm_is_a_distribution(spark, monkeypatch):
    """After any word the probabilities of all known words and one unknown of each class sum to one; and rare words are scored like frequent ones."""
    rng = random.Random(1)
    texts = spark.createDataFrame([(" ".join(rng.choices([f"w{k}" for k in range(40)], k=9)),) for _ in range(50)], "text string")
    model = brown_lm.train(texts)
    c = {bytes(r["word"]): r["c"] for r in model["vocabulary"].collect()}
    total = collections.Counter()
    for word, n in c.items():
        k = model["label"][brown_lm.unit_of(word, model["unit"])]
        total[k] += (n - model["off"][k]) / model["size"][k]
    for k in total:
        assert total[k] + 10 ** model["unseen"][k] == pytest.approx(1)
    assert (10 ** model["moves"]).sum(1) == pytest.approx(np.ones(brown_lm.CLASSES))
    docs = texts.selectExpr("monotonically_increasing_id() AS doc_id", "text || ' new' AS text")
    whole = {r["doc_id"]: r for r in brown_lm.scored(docs, model).collect()}
    top = dict(sorted(model["head"].items(), key=lambda x: -x[1])[:5])
    split = {r["doc_id"]: r for r in brown_lm.scored(docs, model | {"head": top}).collect()}
    for k, r in whole.items():
        assert r["score"] == pytest.approx(split[k]["score"]) and r["base_score"] == pytest.approx(split[k]["base_score"]) and r["n_known"] == split[k]["n_known"] == r["n_tokens"] - 1


def test_head_words(spark):
    df = spark.createDataFrame([(bytearray(f"w{k}".encode()), c) for k, c in enumerate([9, 9, 5, 3, 3, 3, 1, 1])], "word binary, c long")
    assert [len(brown_lm.head_words(df, most)) for most in (1, 2, 3, 5, 6, 7, 8, 99)] == [0, 2, 3, 3, 6, 6, 8, 8]


def test_sample_is_the_first_by_hash(spark):
    from mediasieve.llm.labelled import sample

    df = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    few = {r["doc_id"] for r in sample(df, "toxic", 50).collect()}
    more = {r["doc_id"] for r in sample(df, "toxic", 200).collect()}
    assert len(few) == 100 and few < more and len(more) == 400 and sum(i % 10 == 0 for i in few) == 50


def test_exchange_finds_classes():
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 3, 30)
    pairs = np.array([[rng.poisson(20 if (kind[i] + 1) % 3 == kind[j] else 0.3) for j in range(30)] for i in range(30)], float)
    label = brown_lm.exchange(pairs, classes=3)
    assert len({(a, b) for a, b in zip(kind, label, strict=True)}) == 3


# 8. Media


def test_media(docs, empty):
    rows, _ = rows_of()
    got = media.result(docs.withColumn("kind", F.lit("x"))).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for r in rows:
        raw = text_of(r[1]).encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        want[r[0], len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    features = {r["feature"].split()[0] for r in got}
    assert features == {"wav", "bmp", "png"} and any("corrected" in r["feature"] for r in got)
    assert media.result(empty).count() == 0


def test_sniffing(spark):
    payload = bytes(range(256)) * 4
    wav, bmp, png = media.store_wav(payload), media.store_bmp(payload), media.store_png(payload)
    for kind, blob in (("wav", wav), ("bmp", bmp), ("png", png)):
        assert media.read_samples(kind, blob)[0] == payload
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x03\x01" + b"\x11\xff\x00\x22\xff\xd0\x33" + b"\xff\xd9"
    pdf = b"%PDF-1.4\nx\nstartxref\n9\n%%EOF"
    au = b".snd" + (24).to_bytes(4, "big") + (8).to_bytes(4, "big") + (1).to_bytes(4, "big") + (8000).to_bytes(4, "big") + (1).to_bytes(4, "big") + b"12345678"
    ogg = b"OggS\0\x04" + bytes(8) + b"abcd" + bytes(8) + b"\x01\x05hello"
    mp4 = b"\0\0\0\x10ftypisom\0\0\0\0" + b"\0\0\0\x09mdatx"
    found = media.automaton()
    parts = [("png", png), ("gif", gif), ("jpeg", jpeg), ("pdf", pdf), ("au", au), ("ogg", ogg), ("mp4", mp4), ("bmp", bmp), ("wav", wav)]
    for kind, blob in parts:
        assert (kind, 0, len(blob)) in media.sniff(blob, found), kind
        assert media.sniff(blob[:-1], found) != [(kind, 0, len(blob))], kind
    joined, at, want = b"junk BM RIFF GIF89a", 19, []
    for kind, blob in parts:
        want.append((kind, at, len(blob)))
        joined, at = joined + blob + b"##", at + len(blob) + 2
    assert set(want) <= set(media.sniff(joined, found))
    broken = png[:40] + b"\0" + png[41:]
    df = spark.createDataFrame([(1, bytearray(png), "wav"), (2, bytearray(broken), "png"), (3, None, "png"), (4, bytearray(b"##" + gif), None), (5, bytearray(gif), "gif"), (6, bytearray(), "x")], "id int, data binary, declared string")
    got = {r["id"]: (r["kind"], r["corrected"], len(r["carved"])) for r in media.sniffed(df, "data", "declared").collect()}
    assert got == {1: ("png", True, 0), 2: (None, False, 0), 3: (None, False, 0), 4: (None, False, 1), 5: ("gif", False, 0), 6: (None, False, 0)}


# 9. Toxicity


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    plain = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(600):
        words, kind = rng.choices(plain, k=40), i % 4
        if kind == 0:
            words += ["idiot" + rng.choice(["", "ic", "s"])]
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(kind == 0)))
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], LABELS)
    got = toxicity.result(df, lab).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 600 and {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert toxicity.result(empty, lab).count() == 0
    assert toxicity.result(docs, lab.limit(0)).where("predicted = 0").count() == docs.count()
    clash = toxicity.scored(docs.withColumn("_text", F.lit(1)), toxicity.train(df, lab))
    assert clash.count() == docs.count() and "_text" in clash.columns


def test_machine_learns_pairs():
    from mediasieve.llm.labelled import fit_machine, sigmoid

    rng = np.random.default_rng(0)
    x = (rng.random((600, 6)) < 0.4).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(np.float32)
    b, w, v = fit_machine(x, y)
    inner = x @ v
    z = b + x @ w + 0.5 * ((inner**2).sum(1) - (x * x) @ (v * v).sum(1))
    assert ((sigmoid(z) > 0.5) == (y > 0)).mean() > 0.98


# 10. Sharding


@pytest.mark.parametrize("part_rows,bucket_rows", [(20_000, 1000), (10, 3)])
def test_shards(docs, empty, monkeypatch, part_rows, bucket_rows):
    monkeypatch.setattr(shard, "PART_ROWS", part_rows)
    monkeypatch.setattr(shard, "BUCKET_ROWS", bucket_rows)
    rows, _ = rows_of()
    got = shard.result(docs.withColumn("slot", F.lit(5))).collect()
    key = lambda i, t: repr((i, len(text_of(t).encode()) + 1, zlib.crc32(text_of(t).encode())))
    assert sorted(repr((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == sorted(key(r[0], r[1]) for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = shard.result(docs.repartition(2)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, again)))
    assert shard.result(empty).count() == 0


def test_shards_of_one_key(spark):
    df = spark.range(100).selectExpr("CAST(NULL AS BIGINT) AS k", "id", "1 AS _n", "2 AS _part")
    got = shard.sharded(df, ["k"], n_shards=7).collect()
    sizes = collections.Counter(r["shard"] for r in got)
    assert sorted(sizes.values()) == [14] * 5 + [15] * 2 and {r["id"] for r in got} == set(range(100)) and {(r["_n"], r["_part"]) for r in got} == {(1, 2)}
    assert shard.sharded(df, ["id"], n_shards=1).agg(F.max("slot")).first()[0] == 99


def test_matrix(monkeypatch):
    for below in (10**9, 0):
        monkeypatch.setattr(shard, "_EXACT_BELOW", below)
        total = np.zeros((3, 4))
        for seed in range(600):
            m = shard.communication_matrix([50, 0, 30], [20, 20, 20, 20], seed)
            assert m.sum(1).tolist() == [50, 0, 30] and m.sum(0).tolist() == [20] * 4
            total += m
        assert np.abs(total / 600 - np.array([[12.5] * 4, [0] * 4, [7.5] * 4])).max() < 0.4
        draws = [shard.hypergeometric(30, 50, 20, np.random.default_rng(s)) for s in range(4000)]
        assert abs(np.mean(draws) - 7.5) < 0.12 and abs(np.var(draws) - 20 * 0.375 * 0.625 * 60 / 79) < 0.35


def test_shuffle_is_uniform(spark):
    df = spark.range(64).selectExpr("id AS doc_id")
    seen = collections.Counter()
    for seed in range(0, 60, 3):
        for r in shard.sharded(df, ["doc_id"], 4, seed=seed).collect():
            seen[r["doc_id"] % 2, r["shard"]] += 1
    assert all(abs(n - 160) < 50 for n in seen.values()) and len(seen) == 8


# Queries and pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SMALL, "documents")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*docs.columns, "shard", "slot"]
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    kept = {r["doc_id"] for r in quality.result(docs, table(spark, SMALL, "labels")).where("keep").collect()}
    first = docs.where(F.col("doc_id").isin(*kept))
    rows = [tuple(r) for r in first.select("doc_id", "text").orderBy("doc_id").collect()]
    label = brute_components([simhash(t) for _, t in rows])
    second = [rows[k] for k, c in enumerate(label) if c == k]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    bad = {eval(x)[0] for x in contamination(second, items) if eval(x)[5]}  # noqa: S307
    third = {i for i, _ in second if i not in bad}
    assert ids <= third
    copies = mix_sources.mixed(docs.where(F.col("doc_id").isin(*third)))
    assert out.count() == copies.agg(F.sum("copies")).first()[0]


def test_every_query_runs(spark):
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.QUERIES}
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())
    n = {"documents": table(spark, SMALL, "documents").count(), "pages": table(spark, SMALL, "pages").count()}
    for name, q in queries.QUERIES.items():
        assert q(spark, SMALL).count() == n["pages" if name.startswith(("op4", "op5")) else "documents"], name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = c.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in got.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, got.fetchall()))

