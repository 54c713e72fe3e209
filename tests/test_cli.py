"""The command line, and small helpers that only it and callers use."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediasieve.__main__ import main
from mediasieve.functions import dsp, flac
from mediasieve.functions import text as X
from mediasieve.operators import neardup, quota
from mediasieve.plans import pipeline


def csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_commands(spark, tmp_path, capsys):
    meta = csv(tmp_path, "meta.csv", "id,en,cnt,file,length,q\n1,Owl,A,u,1:00,A\n2,Jay,B,u,0:01,B\n3,Unknown,A,u,1:00,A\n")
    main(["analyze", meta])
    assert "exclusive" in capsys.readouterr().out
    main(["classify", meta, "--output", f"{tmp_path}/status"])
    assert {(r["id"], r["status"]) for r in spark.read.parquet(f"{tmp_path}/status").collect()} == {("1", "ok"), ("2", "skip")}
    clips = csv(tmp_path, "clips.csv", "clip_filename,en,acoustic_salience\n" + "".join(f"xc{k}_{'ABC'[k % 3]}_0.wav,g{k % 3 % 2},0.{k}\n" for k in range(9)))
    main(["balanced", clips, "--target", "4", "--output", f"{tmp_path}/balanced"])
    assert spark.read.parquet(f"{tmp_path}/balanced").count() == 4
    main(["pages", clips, "--samples", "3", "--dry-run"])
    assert "3 rows" in capsys.readouterr().out
    scores = csv(tmp_path, "scores.csv", "clip_filename,label,score\n" + "".join(f"c{k},{k % 2},0.{k}\n" for k in range(10)))
    main(["evaluate", scores, "--output", f"{tmp_path}/m"])
    assert spark.read.parquet(f"{tmp_path}/m").first()["auc"] == pytest.approx(0.6)
    main(["split", scores, "--output", f"{tmp_path}/split.csv"])
    qa = csv(tmp_path, "qa.csv", "clip_filename,issue_type,corrected_onset_ms\nxc1_B_0.wav,no_bird,\nxc2_C_0.wav,wrong_onset,700\n")
    spark.createDataFrame([("1", "B", 3000, 0.5), ("2", "C", 0, 0.1)], "id string, grade string, start_ms long, rms double").write.parquet(f"{tmp_path}/w")
    main(["correct", qa, "--clips", clips, "--windows", f"{tmp_path}/w", "--output", f"{tmp_path}/log"])
    assert {r["new_filename"] for r in spark.read.parquet(f"{tmp_path}/log").collect()} == {"xc1_B_3000.wav", "xc2_C_700.wav"}


def test_audio_commands(spark, tmp_path, capsys):
    """Two recordings with the same sound under two recordists, one other, one too short, one that is no audio."""
    rng, folder = np.random.default_rng(3), tmp_path / "audio"
    folder.mkdir()
    same = rng.normal(size=60_000) * np.linspace(0.01, 0.2, 60_000)
    tone = 0.3 * np.sin(np.arange(60_000) / 3)
    for name, content in {"xc7_A.flac": flac.write(same), "xc9_B.wav": dsp.write_wav(same), "xc12_A.flac": flac.write(tone), "xc3_A.flac": flac.write(tone[:9000]), "xc4_A.flac": b"fLaC"}.items():
        (folder / name).write_bytes(content)
    meta = csv(tmp_path, "m.csv", "id,rec\n7,Ann\n9,Bo\n12,Ann\n")
    main(["dedup", str(folder), "--meta", meta, "--output", f"{tmp_path}/pairs"])
    assert [(r["i"], r["j"], r["kind"], r["removed"], r["taken"]) for r in spark.read.parquet(f"{tmp_path}/pairs").collect()] == [(7, 9, "perfect", 9, True)]
    main(["dedup", str(folder), "--meta", meta])
    assert "older XC7 kept, newer XC9 removed" in capsys.readouterr().out
    main(["extract", str(folder), "--flac", "--output", f"{tmp_path}/clips"])
    got = {r["name"]: r for r in spark.read.parquet(f"{tmp_path}/clips").collect()}
    assert {k: r["reason"] for k, r in got.items() if r["reason"]} == {"xc3_A.flac": "too_short", "xc4_A.flac": "decode: ValueError"}
    assert got["xc7_A.flac"]["clip_filename"] == f"xc7_A_{got['xc7_A.flac']['onset_ms']}.wav" and flac.duration(got["xc7_A.flac"]["content"]) == 3.0
    rows = csv(tmp_path, "rows.csv", "id,en,file,length,q\n1,Owl,,1:00,A\n2,Jay,file:///none,0:01,B\n3,Jay,file:///none,0:10,B\n4,Jay,file:///none,0:10,B\n")
    main(["download", rows, "--limit", "2", "--output", f"{tmp_path}/got"])
    assert spark.read.parquet(f"{tmp_path}/got").count() == 0


def test_helpers(spark):
    got = spark.createDataFrame([(0.0,), (50.0,), (100.0,), (200.0,)], "s double").select(X.cosine_decay("s", 100, 1.0)).collect()
    assert [round(r[0], 6) for r in got] == [1, 0.5, 0, 0]
    df = spark.range(50).withColumnRenamed("id", "k")
    orders = [[r[0] for r in quota.shuffled(df, "k", e).collect()] for e in (0, 0, 1)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[2]) == list(range(50))
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "i long, j long")
    meta = spark.createDataFrame([(1, "44100", "0:10"), (2, "44100", "x"), (3, None, "0:09")], "id long, smp string, length string")
    got = {r["j"]: (r["sample_rate_match"], r["seconds_j"]) for r in neardup.differences(pairs, meta, "id").collect()}
    assert got == {2: (True, 0.0), 3: (None, 9.0)}


def test_cached_features(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    compute = lambda df: df.withColumn("f", F.length("path"))
    every, new = pipeline.cached_features(files, None, compute)
    assert every.count() == 2
    every, again = pipeline.cached_features(files.union(spark.createDataFrame([("c",)], "path string")), new, compute)
    assert {r["path"] for r in again.collect()} == {"c"} and every.count() == 3
