"""Kernels on synthetic waves, file scans and the branches end to end."""

import io
import json
import math
import urllib.error

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediasieve.config import Audio
from mediasieve.functions import dsp
from mediasieve.operators import corrections, neardup, segments
from mediasieve.plans import pipeline
from mediasieve.sources import rest, sinks, tables
from mediasieve.streaming import ingest

SR = 16_000


def burst(seconds, at=None, level=0.5, noise=0.0, seed=0):
    y = np.random.default_rng(seed).normal(0, 1, int(seconds * SR)) * noise
    if at is not None:
        t = np.arange(3 * SR) / SR
        y[int(at * SR) : int(at * SR) + 3 * SR] += level * np.sin(2 * np.pi * 2000 * t)[: len(y) - int(at * SR)]
    return y.astype(np.float32)


def test_wav_round_trip():
    y = burst(0.5, 0, 0.9)
    got, rate = dsp.read_wav(dsp.write_wav(y))
    assert rate == SR and np.abs(got - y).max() < 1e-4
    assert dsp.duration(dsp.write_wav(y)) == pytest.approx(0.5) and dsp.duration(b"no") is None


def test_resample_keeps_a_tone():
    t = np.arange(48_000) / 48_000
    got = dsp.resample(np.sin(2 * np.pi * 440 * t), 48_000)
    want = np.sin(2 * np.pi * 440 * np.arange(SR) / SR)
    assert len(got) == SR and np.abs(got - want)[200:-200].max() < 0.01


def test_windows():
    starts, rms = dsp.window_rms(np.full(48_000 + 1600, 0.25, np.float32), 48_000, 1600)
    assert starts.tolist() == [0, 1600] and rms == pytest.approx([0.25, 0.25])
    starts, rms = dsp.window_rms(np.full(100, 0.5, np.float32), 48_000, 1600)
    assert starts.tolist() == [0] and rms[0] == pytest.approx(0.5)
    assert dsp.loudest(np.zeros(50_000, np.float32), 48_000, 1600) == (None, "all_zero")
    assert dsp.loudest(np.ones(47_999, np.float32), 48_000, 1600) == (None, "too_short")
    assert dsp.loudest(burst(40, 32.3), 48_000, 1600)[0] == 516_800
    clip, at, short = dsp.loudest_or_pad(np.ones(10, np.float32), 48_000, 1600)
    assert len(clip) == 48_000 and at == 0 and short


def test_features():
    y = burst(3, 0)
    assert dsp.log_mel(y).shape == (128, 376) and dsp.log_mel(y, hop=512).shape == (128, 94)
    assert dsp.clip_embedding(y).shape == (256,)
    m = dsp.log_mel(y, bands=64)
    assert m.max() == pytest.approx(0) and m.min() >= -80
    assert abs(dsp.centroid(dsp.spectrum(y))[10:-10].mean() - 2000) < 60
    assert 0 <= dsp.salience(np.zeros(48_000, np.float32)) < dsp.salience(y) <= 1
    pic = dsp.cnn_features(y)
    assert pic.shape == (224, 224) and pic.min() == 0 and pic.max() == 1
    a, b = dsp.frame_embedding(y), dsp.frame_embedding(burst(3, 0, noise=0.05, seed=3))
    assert dsp.frame_similarity(a, a)[0] == pytest.approx(1) and dsp.frame_similarity(a, b)[0] < 0.997
    assert dsp.frame_embedding(y[:1000]) is None


def test_limiters():
    y = np.array([1.0, 0.1, -1.0], np.float32)
    assert dsp.soft_limit(y)[0] == pytest.approx(math.tanh(4.95) / 5)
    assert dsp.curve_limit(y)[0] == pytest.approx(0.99 * 6 / 5.95, rel=1e-5)
    assert dsp.curve_limit(y * 0.5)[0] == 0.5


def waves(spark, rows):
    return spark.createDataFrame([(k, y.tolist() if y is not None else None) for k, y in rows], "rec_id long, samples array<float>")


def test_positive_and_negative_clips(spark):
    df = waves(spark, [(1, burst(8, 4)), (2, burst(2, 0)), (3, np.full(50_000, 0.0005, np.float32)), (4, None), (5, burst(12, 4, 1.0))])
    got = {r["rec_id"]: r for r in segments.positive_clips(df).collect()}
    assert got[1]["onset_ms"] == 4000 and len(got[1]["samples"]) == 48_000 and got[2]["reason"] == "too_short" and got[3]["status"] == "ok" and got[4]["reason"] == "too_short"
    assert max(got[5]["samples"]) <= 0.2
    two = segments.positive_clips(df.where("rec_id = 1"), count=2).collect()
    assert len(two) == 2 and abs(two[0]["onset_ms"] - two[1]["onset_ms"]) >= 1500
    neg = {r["rec_id"]: r for r in segments.negative_clips(df, pad=True).collect()}
    assert neg[2]["is_short"] and neg[1]["onset_ms"] == 4000 and neg[4]["reason"] == "too_short"
    assert {r["rec_id"]: r["reason"] for r in segments.negative_clips(df).collect()}[2] == "too_short"
    cut = segments.clip_at(df.where("rec_id = 1").withColumn("onset", F.lit(7000)), "onset").first()["clip"]
    assert len(cut) == 48_000 and cut[-1] == 0
    feats = {r["rec_id"]: r for r in segments.features(df).collect()}
    assert len(feats[1]["embedding"]) == 256 and feats[4]["embedding"] is None


def test_windows_as_functions(spark):
    df = waves(spark, [(1, np.ones(6, np.float32)), (2, None)])
    got = {r["rec_id"]: r["w"] for r in df.select("rec_id", segments.array_windows("samples", 4, 2).alias("w")).collect()}
    assert [(x["start"], x["rms"]) for x in got[1]] == [(0, 1), (2, 1)] and got[2] is None
    spark.udtf.register("audio_windows", segments.Windows)
    df.createOrReplaceTempView("waves")
    rows = spark.sql("SELECT w.start FROM waves, LATERAL audio_windows(samples, 4, 2) w WHERE rec_id = 1").collect()
    assert sorted(r[0] for r in rows) == [0, 2]


def test_duplicates_end_to_end(spark):
    base = burst(4, 0.5, noise=0.02, seed=1)
    df = waves(spark, [(1, base), (2, base.copy()), (3, burst(4, 0.2, noise=0.3, seed=9)), (4, base.copy()), (5, np.zeros(100, np.float32))])
    meta = spark.createDataFrame([(1, "s1", 4.0, "ann"), (2, "s2", 4.0, "bob"), (3, "s3", 4.0, "ann"), (4, "s4", 9.0, "ann"), (5, "s5", None, "")], "rec_id long, source string, seconds double, rec string")
    pairs, removed = pipeline.duplicates(df, meta)
    assert [r["rec_id"] for r in removed.collect()] == [2]
    assert {(r["i"], r["j"], r["kind"]) for r in pairs.collect()} == {(1, 2, "perfect")}


def test_only_the_first_three_seconds_decide(spark):
    """Recordings that part after 3 s are perfect duplicates; ones that part before are not."""
    a, b, c = (burst(5, 0.5, noise=0.02, seed=k) for k in (1, 2, 3))
    b[:48_000] = a[:48_000]
    c[48_000:] = a[48_000:]
    emb = neardup.embeddings(waves(spark, [(1, a), (2, b), (3, c)]), "rec_id")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "i long, j long")
    got = {r["j"]: r for r in neardup.verified(pairs, emb, "rec_id", "frames", 128).collect()}
    assert got[2]["kind"] == "perfect" and got[2]["min_sim"] == pytest.approx(1, abs=1e-5) and got[3]["kind"] != "perfect"
    assert len(emb.first()["frames"]) == 128 * (48_000 // 128 + 1)


def test_clips_and_balance(spark):
    df = waves(spark, [(k, burst(4, 0.5, 0.2 + k / 50, 0.01, k)) for k in range(8)])
    clips = pipeline.clips(df).selectExpr("*", "CASE WHEN rec_id < 6 THEN 'a' ELSE 'b' END AS species", "CAST(rec_id AS STRING) AS clip_filename", "3 AS quality_score", "salience AS acoustic_salience")
    got = pipeline.balanced_set(clips, target=5, k=2).collect()
    assert len(got) == 5 and {r["species"] for r in got} == {"a", "b"}


def test_files(spark, tmp_path):
    for name, y in (("positive/x/xc1_A.wav", burst(3.5, 0)), ("positive/top.wav", burst(3, 0)), ("negative/n.wav", burst(3, 0)), ("negative/.hidden.wav", burst(3, 0))):
        p = tmp_path / "set" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(dsp.write_wav(y))
    (tmp_path / "set/negative/empty.wav").write_bytes(b"")
    (tmp_path / "set/negative/note.txt").write_text("x")
    (tmp_path / "set/positive/x/bad.wav").write_bytes(b"RIFFxxxx")
    root = f"file:{tmp_path}/set"
    got = {(r["path"].rpartition("/")[2], r["label"], r["subdir"]) for r in tables.labelled(spark, root, {"positive": 1, "negative": 0}).collect()}
    assert got == {("xc1_A.wav", 1, "x"), ("bad.wav", 1, "x"), ("n.wav", 0, "")}
    found = tables.files(spark, root, content=True).where(F.col("folder") == "x")
    dec = {r["name"]: r for r in segments.decoded(found).collect()}
    assert dec["xc1_A.wav"]["seconds"] == pytest.approx(3.5) and dec["bad.wav"]["samples"] is None and dec["bad.wav"]["reason"].startswith("decode")
    secs = {r["name"]: r["seconds"] for r in tables.durations(found).collect()}
    assert secs["xc1_A.wav"] == pytest.approx(3.5) and secs["bad.wav"] is None
    # Hidden and empty files are not listed.
    assert tables.without_folders(tables.files(spark, root), ["x"]).count() == 2


def test_tables_and_sinks(spark, tmp_path):
    p = str(tmp_path / "meta.csv")
    with open(p, "w") as f:
        f.write('id,en,rec\n1,"a ""b""",x\n1,c,y\nzz,d,z\n,e,w\n')
    df = tables.csv_text(spark, p, ["id", "en", "rec"]).withColumn("n", F.monotonically_increasing_id())
    assert [(r["id"], r["en"]) for r in tables.keyed(df, "id", ["n"]).collect()] == [(1, "c")]
    assert {r["id"] for r in tables.keyed(df, "id", ["n"], numeric=False).collect()} == {"1", "zz"}
    with pytest.raises(ValueError):
        tables.csv_checked(spark, p, ["id", "nope"])
    assert tables.optional(spark, lambda: spark.read.parquet(f"{tmp_path}/none"), "a int").count() == 0
    out = f"{tmp_path}/t"
    spark.range(5).write.parquet(out)
    sinks.replace_table(spark.read.parquet(out).where("id > 2"), out)
    assert spark.read.parquet(out).count() == 2
    sinks.write_csv(df.drop("n"), f"{tmp_path}/csv")
    assert tables.csv_text(spark, f"{tmp_path}/csv", ["id", "en", "rec"]).where("en = 'a \"b\"'").count() == 1
    sinks.write_by_status(df.withColumn("status", F.lit("ok")), f"{tmp_path}/st")
    assert spark.read.parquet(f"{tmp_path}/st/status=ok").count() == 4
    wav = sinks.with_wav(waves(spark, [(1, burst(0.1, 0)), (2, None)])).orderBy("rec_id").collect()
    assert dsp.duration(bytes(wav[0]["content"])) == pytest.approx(0.1) and wav[1]["content"] is None
    assert "ok" in sinks.report_text("t", {"s": spark.createDataFrame([("ok", 1)], "a string, n int")})


def test_saved_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"numPages": "2", "recordings": [{"id": "1", "en": "a"}, {"id": "2", "en": None}]}))
    (tmp_path / "2.json").write_text("{not json")
    (tmp_path / "3.json").write_text(json.dumps({"num_pages": 2, "recordings": []}))
    got = tables.saved_pages(spark, str(tmp_path), "id:string,en:string").collect()
    assert sorted((r["num_pages"], r["id"]) for r in got) == [(2, "1"), (2, "2")]


class Answer(io.BytesIO):
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_rest_pages_and_retries():
    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return Answer(json.dumps({"page_count": 1, "recordings": [{"id": 1, "sono": "x"}]}).encode())

    assert rest.get("u", opener=opener, sleep=waits.append)["page_count"] == 1 and waits == [0.2, 1, 0.2, 2, 0.2]

    def refused(url, timeout):
        raise urllib.error.HTTPError(url, 404, "no", {}, None)

    assert rest.get("u", opener=refused, sleep=waits.append) is None
    answers = {1: {"numPages": 3, "recordings": [{"id": 1, "sono": 0}]}, 2: {"recordings": [{"id": 2}]}, 3: {"recordings": []}}
    assert list(rest.pages(answers.get)) == [{"id": 1}, {"id": 2}]
    assert rest.download("u", opener=lambda u, timeout: Answer(b"x" * 2000), sleep=waits.append)[0] == b"x" * 2000
    assert rest.download("u", retries=1, opener=lambda u, timeout: Answer(b"x"), sleep=waits.append)[1].startswith("too small")


def test_rest_source(spark, tmp_path):
    import http.server
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            page = int(self.path.partition("page=")[2].partition("&")[0])
            body = json.dumps({"numPages": 2, "recordings": [{"id": f"{page}", "en": "x", "cnt": self.path.partition("%22")[2].partition("%22")[0]}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rest.register(spark)
    df = spark.read.format("paged_rest").schema("id string, en string, cnt string").option("url", f"http://127.0.0.1:{server.server_port}/r").option("values", "A,B").option("wait", "0").load()
    assert sorted((r["cnt"], r["id"]) for r in df.collect()) == [("A", "1"), ("A", "2"), ("B", "1"), ("B", "2")]
    assert sorted((r["cnt"], r["id"]) for r in df.where("cnt = 'B' and id = '2'").collect()) == [("B", "2")]
    server.shutdown()


def test_negative_manifests(spark):
    flags = spark.createDataFrame([("a", 0), ("b", 1)], "itemid string, hasbird int")
    assert [r["key"] for r in tables.negatives(flags, "flags").collect()] == ["a"]
    classes = spark.createDataFrame([("x/1.wav", "23"), ("2.wav", "4"), ("3.wav", None)], "`Dataset File Name` string, `Class ID` string")
    assert sorted(r["key"] for r in tables.negatives(classes, "classes").collect()) == ["2", "3"]
    cats = spark.createDataFrame([("1.wav", "hen"), ("2.wav", "rain")], "filename string, category string")
    assert [r["key"] for r in tables.negatives(cats, "categories").collect()] == ["2"]
    waves_of = spark.createDataFrame([("a", burst(5, 1).tolist())], "key string, samples array<float>")
    assert pipeline.negative_set(flags, "flags", waves_of, "src").first()["name"] == "src-a-01000.wav"


def test_source_windows(spark):
    audio = Audio(rate=10, window_s=0.4, hop_s=0.2)
    df = spark.createDataFrame([(1, "A", [1.0] * 8)], "id long, grade string, samples array<float>")
    got = corrections.source_windows(df, audio=audio).orderBy("start_ms").collect()
    assert [(r["id"], r["start_ms"], r["rms"]) for r in got] == [("1", 0, 1.0), ("1", 200, 1.0), ("1", 400, 1.0)]


def test_recordings(spark):
    rows = [("1", "Owl", "u", "1:00", "A"), ("1.0", "Owl", "u", "2:00", "A"), ("2", "Unknown", "u", "1:00", "B"), (" ", "Owl x", "u", "1:00", None)]
    got = {r["id"]: r for r in pipeline.recordings(spark.createDataFrame(rows, "id string, en string, file string, length string, q string")).collect()}
    assert set(got) == {"1", " "} and got["1"]["out_path"] == "Owl/xc1_A.flac" and got[" "]["error"] == "missing id"


def test_stream(spark, tmp_path):
    schema = "id string, file string, length string, ts timestamp"
    src = f"{tmp_path}/in"
    spark.createDataFrame([("1", "u", "1:00"), ("1", "u", "1:00"), ("2", "na", "1:00")], "id string, file string, length string").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).write.parquet(src)
    stream = ingest.classified(ingest.deduplicated(ingest.file_stream(spark, src, schema), ["id"], "ts"))
    ingest.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert {(r["id"], r["error"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("1", ""), ("2", "no_url")}
