"""Operators on small golden tables, against plain Python models, and by properties."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediasieve.functions import arrays as A
from mediasieve.functions import text as X
from mediasieve.operators import balance, clustering, corrections, graph, hygiene, metrics, neardup, quota, segments
from mediasieve.storage import first_rows, ranked, ranked_within, running


def column(spark, values, kind, f):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.orderBy("k").select(f(F.col("v"))).collect()]


def test_durations(spark):
    values = ["0:02", "0:03", "1:05", "1:00:00", "7.5", "abc", "", None]
    assert column(spark, values, "string", X.seconds_loose) == [2, 3, 65, 0, 7.5, 0, 0, 0]
    assert column(spark, values, "string", X.seconds_clock) == [2, 3, 65, 3600, None, None, None, None]


def test_names(spark):
    assert column(spark, [" a/b  c ", "", None, 'x:*?"<>|\\y'], "string", X.sanitize_name) == ["a_b_c", "unknown_species", "unknown_species", "x_________y"[:1] + "_" * 8 + "y"]
    urls = ["https://h/a/b.WAV?x=1", "//h/dir/%61.flac", "https://h/none", None, "https://h/.hidden", "https://h/a%20b.mp3#t"]
    assert column(spark, urls, "string", X.url_extension) == [".WAV", ".flac", ".mp3", ".mp3", ".mp3", ".mp3"]
    assert column(spark, ["12.0", "XC12", " 7 ", "none", "", "1e2"], "string", X.canonical_id) == ["12", "12", "7", "none", "", "100"]
    assert column(spark, ["no score", None, "a", "Unrated", "", "b+"], "string", X.grade_of) == ["U", "U", "A", "U", "U", "B"]
    names = ["xc1_A_0.wav", "xc1_E_0.wav", "xc1_U_0.wav", "XC2_b_300.wav", "noise.wav"]
    assert column(spark, names, "string", X.name_grade) == ["A", "U", "U", "B", "U"]
    assert [None if p is None else tuple(p) for p in column(spark, names, "string", X.clip_parts)] == [("1", "A", 0), ("1", "E", 0), None, None, None]
    assert column(spark, names, "string", X.record_number) == [1, 1, 1, 2, 0]
    assert column(spark, names, "string", X.source_key) == ["xc1_A", "xc1_E", "xc1_U", "XC2_b", "noise"]
    assert column(spark, ["/r/sp/xc1_A.flac", "a.tar.gz", ".x"], "string", X.stem) == ["xc1_A", "a.tar", ".x"]
    assert column(spark, [3661.9, 61.0, 5.0], "double", X.spoken_time) == ["1h 1m 1s", "1m 1s", "5s"]
    assert column(spark, [516_800], "long", X.onset_ms) == [32_300] and column(spark, [516_800], "long", X.onset_ms_floor) == [32_300]


def test_arrays(spark):
    y = [[0.5, -0.5], [], [1.0, 0.1], [0.0, 0.0]]
    assert column(spark, y, "array<double>", A.rms) == pytest.approx([0.5, 0, np.sqrt(1.01 / 2), 0])
    assert column(spark, y, "array<double>", A.clipped) == [False, False, True, False]
    assert max(column(spark, y, "array<double>", A.soft_limit)[2]) == pytest.approx(np.tanh(4.95) / 5)
    assert column(spark, y, "array<double>", A.curve_limit)[2][0] == pytest.approx(0.99 * 6 / 5.95)
    assert column(spark, y, "array<double>", lambda c: A.fitted(c, 3))[:2] == [[0.5, -0.5, 0], [0, 0, 0]]
    assert column(spark, [[1.0, 2.0]], "array<double>", lambda c: A.repeated(c, 5)) == [[1, 2, 1, 2, 1]]
    assert column(spark, [[3.0, 4.0], [0.0, 0.0]], "array<double>", A.unit) == [[0.6, 0.8], [0, 0]]
    assert column(spark, [[3.0, 5.0, 4.0], [1.0]], "array<double>", A.min_max) == [[0, 1, 0.5], [0]]


def test_status(spark):
    rows = [("", "u", "1:00"), ("1", "nan", "1:00"), ("2", "u", "0:02"), ("3", "u", "1:00"), ("4", None, "1:00"), ("5", "u", "1:00:00")]
    df = spark.createDataFrame(rows, "id string, file string, length string")
    got = df.select("id", hygiene.status_of("id", "file", "length").alias("s")).select("id", "s.*").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("", "skip", "missing id"), ("1", "skip", "no_url"), ("2", "skip", "too_short"), ("3", "ok", ""), ("4", "skip", "no_url"), ("5", "skip", "too_short")]


def test_exclusion_keeps_nulls(spark):
    df = spark.createDataFrame([("Unknown",), (None,), ("Owl",)], "en string")
    assert {r[0] for r in hygiene.excluded(df, "en").collect()} == {None, "Owl"}


def test_match_grade_and_enrich(spark):
    files = spark.createDataFrame([(1, "N"), (2, "a"), (3, "B")], "id long, g string")
    meta = spark.createDataFrame([(1, "no score"), (2, "A"), (3, "C")], "id long, q string")
    assert sorted(r["id"] for r in hygiene.match_grade(files, meta, "id", "g", "q").collect()) == [1, 2]
    got = hygiene.enrich(files, meta.where("id = 1"), "id", {"q": F.lit("?")}).orderBy("id").collect()
    assert [r["q"] for r in got] == ["no score", "?", "?"]


def gini(counts):
    c = np.sort(counts)
    n = len(c)
    return 2 * (np.arange(1, n + 1) * c).sum() / (n * c.sum()) - (n + 1) / n


@pytest.mark.parametrize("counts", [[3, 3, 3], [1, 2, 3, 10], [5], [1, 1, 1, 50]])
def test_gini(spark, counts):
    df = spark.createDataFrame([(k,) for k, n in enumerate(counts) for _ in range(n)], "g int")
    assert hygiene.gini(df, "g").first()[0] == pytest.approx(gini(counts), abs=1e-9)


def test_gini_of_nothing(spark):
    assert hygiene.gini(spark.createDataFrame([], "g int"), "g").first()[0] == 0.0


def test_ranked_and_running(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS m").repartition(5)
    want = {r: k for k, r in enumerate(sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1])), 1)}
    assert {(r["m"], r["id"]): r["rank"] for r in ranked(df, F.desc("m"), "id").collect()} == want
    sums = {r["id"]: r["s"] for r in running(df, ["id"], {"s": "m"}).collect()}
    assert [sums[i] for i in range(1000)] == list(np.cumsum([i % 7 for i in range(1000)]))


def test_first_rows(spark, monkeypatch):
    df = spark.range(500).selectExpr("id", "id * 37 % 101 AS m").repartition(7)
    few = [r["id"] for r in first_rows(df, 120, F.desc("m"), "id").collect()]
    monkeypatch.setattr("mediasieve.storage.FEW", 10)
    assert sorted(few) == sorted(r["id"] for r in first_rows(df, 120, F.desc("m"), "id").collect()) and len(few) == 120
    assert first_rows(df, 0, "id").count() == 0


@pytest.mark.parametrize("mode", ["compatible", "strict"])
@pytest.mark.parametrize("target", [0, 7, 30, 60, 500])
def test_balanced_properties(spark, mode, target):
    rng = random.Random(target)
    rows = [(i, f"g{min(rng.randrange(8), rng.randrange(8))}", rng.randrange(1, 6), rng.random(), rng.randrange(-1, 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, species string, score int, salience double, cluster_id int")
    got = balance.balanced(df, "species", "id", "score", "salience", target=target, mode=mode).collect()
    ids = [r["id"] for r in got]
    assert len(ids) == len(set(ids)) == min(target, 120)
    groups = len({r[1] for r in rows})
    if target >= groups:
        assert len({r["species"] for r in got}) == groups


def test_balanced_dedup_key(spark):
    df = spark.createDataFrame([(i, "a" if i < 9 else "b", 3, i / 20, 0, f"t{i % 6}") for i in range(12)], "id long, species string, score int, salience double, cluster_id int, text string")
    got = balance.balanced(df, "species", "id", "score", "salience", target=8, dedup_key="text").collect()
    assert len({r["text"] for r in got}) == len(got) == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.integers(1, 5), st.integers(1, 9))
def test_separated(levels, count, apart):
    from mediasieve.functions import dsp

    starts, rms = np.arange(len(levels)) * 2, np.array(levels, float)
    got = dsp.separated(starts, rms, count, apart)
    taken = []
    for k in sorted(range(len(levels)), key=lambda k: (-levels[k], k)):
        if len(taken) < count and all(abs(starts[k] - starts[t]) >= apart for t in taken):
            taken.append(k)
    assert got == taken


def greedy(pairs):
    gone, out = set(), {}
    for i, j, r in sorted(pairs):
        if i in gone or j in gone:
            out[i, j] = False
        else:
            gone.add(j if r == "j" else i)
            out[i, j] = True
    return out


@pytest.mark.parametrize("seed", range(4))
def test_resolution_is_sequential(spark, seed):
    rng = random.Random(seed)
    pairs = {(i, j) for i, j in (sorted(rng.sample(range(25), 2)) for _ in range(60))}
    pairs = [(i, j, rng.choice("ij")) for i, j in pairs] + [(100, k, "j") for k in range(101, 120)]
    df = spark.createDataFrame(pairs, "i long, j long, removes string")
    got = {(r["i"], r["j"]): r["taken"] for r in neardup.resolved(df, ["i", "j"], "i", "j").collect()}
    assert got == greedy(pairs)
    for at_once in (1, 30):  # every component in rounds; the one of 19 pairs in a task, the other in rounds
        parts = neardup.resolved(df, ["i", "j"], "i", "j", at_once=at_once)
        assert {(r["i"], r["j"]): r["taken"] for r in parts.collect()} == greedy(pairs)


def test_greedy_resolution_of_a_long_chain(spark):
    """Each pair waits for the one before; null files stand for none and never go."""
    chain = [(k, k + 1, "j") for k in range(5000)]
    df = spark.createDataFrame([*chain, (None, 5000, "i"), (None, None, "j")], "i long, j long, removes string").withColumn("o", F.monotonically_increasing_id())
    got = neardup.resolved(df, ["o"], "i", "j").collect()
    assert {r["i"]: r["taken"] for r in got if r["i"] is not None} == {k: k % 2 == 0 for k in range(5000)}
    assert [r["taken"] for r in got if r["i"] is None] == [True, True]


def test_keep_rule(spark):
    rows = [(5, 9, "x", "x "), (5, 9, "x", "y"), (9, 5, "x", "y"), (5, 9, "", None), (7, 7, "x", "y")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, xc_i long, xc_j long, rec_i string, rec_j string")
    got = neardup.with_keep_rule(df).orderBy("k").collect()
    assert [(r["removed"], r["kept"], r["removes"], r["same_recordist"]) for r in got] == [(5, 9, "i", True), (9, 5, "j", False), (9, 5, "i", False), (5, 9, "i", True), (7, 7, "i", False)]


def test_neighbours_exact_over_blocks(spark):
    x = np.random.default_rng(1).normal(size=(70, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {(r["i"], r["place"]): r["j"] for r in neardup.neighbours(df, "id", "v", k=4, block=16).collect()}
    want = np.argsort(-(u @ u.T), axis=1, kind="stable")[:, :4]
    assert got == {(i, p + 1): int(want[i, p]) for i in range(70) for p in range(4)}


def test_duration_rule(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.5), (None, 1.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(neardup.duration_ok(F.col("a"), F.col("b"))).collect()] == [True, False, False, True]


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 1)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 1, 9: 1, 10: 1}
    chain = graph.components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")).collect()
    assert {r["root"] for r in chain} == {0} and len(chain) == 61


@pytest.mark.parametrize("few", [graph.FEW_LINKS, 99, 0])
def test_components_in_one_task_or_in_rounds(spark, monkeypatch, few):
    """Equal to a search from every node; few links cost the driver a handful of jobs, however many rounds they would take."""
    monkeypatch.setattr(graph, "FEW_LINKS", few)
    rng = random.Random(few)
    edges = [(rng.randrange(-150, 150), rng.randrange(-150, 150)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(100)] + [(2000, 2001 + i) for i in range(50)]
    edges += [(None, 5), (7, None), (-(2**63), 2**63 - 1), *edges[:5]]
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        front = [start] * (start not in want)
        while front:
            x = front.pop()
            if x not in want:
                want[x] = start
                front += near[x]
    spark.sparkContext.setJobGroup(f"components {few}", "components")
    got = graph.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components {few}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want
    assert jobs <= 10 or few < len(edges)
    assert graph.components(spark.createDataFrame([(3, 3), (None, 1)], "a long, b long")).count() == 0


def test_quota_and_split(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 30 THEN 0 WHEN id < 50 THEN 1 ELSE 2 END AS p", "id % 2 AS y")
    got = quota.priority_quota(df, F.col("p"), 60, "id", sampled=2).collect()
    assert len(got) == 60 and {r["id"] for r in got if r["p"] < 2} == set(range(50))
    split = quota.stratified_split(df, "y", "id").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in split} == {(y, s): n for y in (0, 1) for s, n in (("test", 5), ("valid", 5), ("train", 40))}


def test_metrics_by_hand(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.randrange(11) / 10) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.auc(df).first()[0] == pytest.approx(auc)
    c = metrics.confusion(df).first()
    assert c["tp"] == sum(s > 0.5 for s in pos) and c["fp"] == sum(s > 0.5 for s in neg)
    for r in metrics.f1_sweep(df).collect():
        tp, said = sum(s >= r["threshold"] for s in pos), sum(s >= r["threshold"] for _, s in rows)
        assert r["f1"] == pytest.approx(2 * tp / (said + len(pos)))
    assert metrics.both_classes(df) and not metrics.both_classes(df.where("label = 1"))


def test_clusters(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "big", (rng.normal(size=2) * 0.01 + [i % 5 * 10, i % 5 % 2 * 30]).tolist()) for i in range(50)]
    rows += [(100 + i, "small", [float(i), 0.0]) for i in range(3)] + [(200, "big", None), (300, "none", None)] + [(301 + i, "none", None) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, g string, v array<double>")
    got = {r["id"]: r["cluster_id"] for r in clustering.cluster_within(df, "g", "id", "v", [F.asc("id")]).collect()}
    assert [got[100 + i] for i in range(3)] == [0, 1, 2] and got[200] == -1 and got[300] == 0
    assert len({got[i] for i in range(50)}) == 5 and all(got[i] == got[i % 5] for i in range(50))


def test_clusters_come_from_all_rows(spark):
    """A cluster whose rows all come after the first 20,000 in hash order has a centre of its own."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.orderBy(quota.hash_order("id", 42), "id"))
    df = spark.range(20_400).withColumn("rank", rank).selectExpr("id", "'big' AS g", "array(CASE WHEN rank > 20000 THEN 100D ELSE id % 4 * 10D END) AS v")
    got = clustering.cluster_within(df, "g", "id", "v", [F.asc("id")])
    assert got.count() == 20_400
    pairs = got.selectExpr("v[0] AS v", "cluster_id").distinct().collect()
    assert len(pairs) == 5 == len({r["cluster_id"] for r in pairs})


def test_corrections(spark):
    qa = [("xc1_A_0.wav", "wrong_onset", "2500"), ("xc1_A_0.wav", "wrong_onset", ""), ("xc1_A_2500.wav", "no_bird", ""), ("xc1_U_0.wav", "no_bird", ""), ("xc2_B_0.wav", "noise_dominated", ""), ("xc1_A_0.wav", "odd", ""), ("xc1_A_9000.wav", "Noise_Dominated", "100")]
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(qa)], "seq long, clip_filename string, issue_type string, corrected_onset_ms string")
    onsets = spark.createDataFrame([("1", 0), ("1", 6000), ("2", 0)], "id string, onset_ms long")
    w = spark.createDataFrame([("1", "A", s, r) for s, r in ((0, 0.5), (1000, 0.2), (6500, 0.9), (9000, 0.2), (12000, 0.0001))] + [("2", "A", 0, 0.5)], "id string, grade string, start_ms long, rms double")
    log = corrections.applied(rows, onsets, w, "seq")
    got = [(r["result"], r["new_filename"]) for r in log.orderBy("seq").collect()]
    assert got == [("corrected", "xc1_A_2500.wav"), ("skipped", ""), ("replaced", "xc1_A_0.wav"), ("error", ""), ("removed_no_replacement", ""), ("skipped", ""), ("corrected", "xc1_A_100.wav")]
    assert corrections.summary(log).first()["net_change"] == -1


def test_segments_over_rows(spark):
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate([0, 0, 3, 4, 0, 0, 3, 4])] + [(2, 0, 2.0), (2, 1, 2.0)], "r int, t int, v double")
    w = segments.row_windows(df, "r", ["t"], "v", 4, 2)
    got = {(r["r"], r["start"]): round(r["rms"], 6) for r in w.collect()}
    assert got == {(1, 0): 2.5, (1, 2): 2.5, (1, 4): 2.5, (2, 0): 2.0}
    assert {(r["r"], r["start"]) for r in segments.loudest(w, "r").collect()} == {(1, 0), (2, 0)}
    used = spark.createDataFrame([(1, 1), (1, None)], "r int, used long")
    assert {(r["r"], r["start"]) for r in segments.away_from(w, used, "r", 2).collect()} == {(1, 4), (2, 0)}


def test_ranks_within_groups(spark):
    df = spark.createDataFrame([("hot", k) for k in range(500)] + [("b", 3), ("b", 1), (None, 7), (None, 5)], "g string, k long").repartition(5)
    got = ranked_within(df, "g", "k", name="r", size="n").collect()
    want = {("hot", k): (k + 1, 500) for k in range(500)} | {("b", 1): (1, 2), ("b", 3): (2, 2), (None, 5): (1, 2), (None, 7): (2, 2)}
    assert {(x["g"], x["k"]): (x["r"], x["n"]) for x in got} == want and len(got) == len(want)


def test_median_by_ranks(spark):
    for values, median in (([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0, 3.0, 2.0, None], 2.5), ([], None)):
        assert [r["median"] for r in hygiene.describe(spark.createDataFrame([(v,) for v in values], "x double"), "x").collect()] == [median]
