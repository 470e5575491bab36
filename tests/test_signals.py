"""Kernels on synthetic signals, WAV bytes, packs and the stream gate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import dsp
from tessera.sources import files, wav

SR = 44100


def harmonic(midi, partials, seconds=2.0):
    t = np.arange(int(SR * seconds)) / SR
    f = 440 * 2 ** ((midi - 69) / 12)
    x = sum(a * np.sin(2 * np.pi * f * h * t) for h, a in partials.items())
    ramp = np.minimum(1, np.minimum(np.arange(len(t)), np.arange(len(t))[::-1]) / (0.02 * SR))
    return (0.5 * x * ramp / np.abs(x).max()).astype(np.float32)


@pytest.mark.parametrize(
    ("midi", "partials", "low", "high"),
    [(48, {1: 1, 2: 0.15}, 47.4, 48.6), (48, {1: 1, 2: 0.9, 3: 0.8, 4: 0.6, 5: 0.5, 6: 0.4}, 47.4, 48.6), (48.3, {1: 1, 2: 0.3}, 48.1, 48.5)],
)
def test_spectral_pitch(midi, partials, low, high):
    assert low <= dsp.spectral_midi(harmonic(midi, partials), SR, 48) <= high


@pytest.mark.parametrize(("midi", "partials", "target", "pc"), [(36, {1: 0.4, 2: 1, 3: 0.5, 4: 0.7}, 36, 0), (40, {1: 1, 2: 0.7, 3: 0.5, 4: 0.3}, 40, 4), (65, {1: 1, 2: 0.5, 3: 0.4}, 48, 5)])
def test_pitch_class(midi, partials, target, pc):
    got = dsp.spectral_midi(harmonic(midi, partials), SR, target)
    assert round(got) % 12 == pc and abs(got - target) <= 7


def test_silence_and_sub_bass():
    assert np.isnan(dsp.spectral_midi(np.zeros(SR, np.float32), SR, 48))
    x = harmonic(40, {1: 1, 2: 0.5})
    assert dsp.sub_bass_check(x, SR, 40, 42.0)[1] and abs(dsp.sub_bass_check(x, SR, 40, 42.0)[0] - 40) < 1
    assert dsp.sub_bass_check(x, SR, 40, 40.0)[:2] == (40.0, False)
    noise = np.random.default_rng(0).normal(0, 0.3, SR)
    assert dsp.sub_bass_check(noise, SR, 40, 42.0)[:2] == (42.0, False)


def test_loudness_of_a_full_scale_tone():
    x = np.sin(2 * np.pi * 997 * np.arange(4 * 48000) / 48000)
    assert abs(dsp.loudness(x, 48000) + 3.01) < 0.1
    y, out = dsp.normalized_loudness(0.1 * x, 48000, -20.0)
    assert abs(out + 20) < 0.1 and np.abs(y).max() <= 10 ** (-1 / 20) + 1e-6
    assert dsp.normalized_loudness(np.zeros(1000), 48000, -20.0)[1] is None


def test_vibrato_and_shift():
    t = np.arange(200) * 0.01
    assert dsp.vibrato(30 * np.sin(2 * np.pi * 5 * t)) and not dsp.vibrato(np.zeros(200)) and not dsp.vibrato(np.zeros(10))
    up = dsp.shifted(harmonic(48, {1: 1}), 12)
    assert abs(dsp.spectral_midi(up, SR, 60) - 60) < 0.2


@pytest.mark.parametrize("bits", [16, 24])
def test_wav_round_trip(bits):
    x = np.random.default_rng(1).uniform(-1, 1, (500, 2)).astype(np.float32)
    y, rate = wav.decode(wav.encode(x, 22050, bits, comment="a prompt", software="tessera"))
    assert rate == 22050 and y.shape == x.shape and np.abs(x - y).max() < 2 / (1 << (bits - 1))


def test_wav_scan_isolates_damage(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav.encode(harmonic(69, {1: 1}, 0.5), SR))
    (tmp_path / "b.wav").write_bytes(b"no audio")
    (tmp_path / "c.txt").write_text("x")
    out = wav.measured(wav.read_wavs(spark, str(tmp_path)), lambda x, sr: {"n": len(x), "peak": float(np.abs(x).max())}, "n long, peak double").orderBy("path").collect()
    assert [r.n for r in out] == [SR // 2, None] and out[1].read_error.startswith("read_failed")


def test_campaign(spark):
    from tessera.plans.curation import campaign

    texts = spark.createDataFrame([("keys", "\n".join(f"prompt number {i}" for i in range(12)))], "category string, text string")
    winners, failures = campaign(texts, [45, 57], 2, 0.3)
    won, lost = winners.collect(), failures.collect()
    assert len(won) + len(lost) == 24 and won
    assert all(abs(r.midi - r.target) < 0.5 or abs(abs(r.midi - r.target) - 12) < 0.5 for r in won)


def test_pack_is_the_same_each_time(tmp_path):
    for name in ("b/x.wav", "a.wav", "_archive/old.wav", ".DS_Store"):
        p = tmp_path / "src" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(name.encode())
    found = files.payload(str(tmp_path / "src"))
    assert [n for n, _ in found] == ["a.wav", "b/x.wav"]
    manifest = {"packId": "p", "buildDate": "2024-01-01T00:00:00Z", "fileCount": 3}
    assert files.digest(files.zip_pack(found, manifest)) == files.digest(files.zip_pack(found, manifest))
    files.directory_pack(found, manifest, str(tmp_path / "out"))
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "keep").write_text("x")
    with pytest.raises(FileExistsError):
        files.directory_pack(found, manifest, str(tmp_path / "other"))


def test_text_sources(spark, tmp_path):
    (tmp_path / "kick.txt").write_text("# c\none\ntwo\n")
    assert [(r.category, r.text) for r in files.prompt_files(spark, str(tmp_path / "kick.txt")).collect()] == [("kick", "# c\none\ntwo\n")]
    (tmp_path / "list").write_text("a # on\n#b\n\nc\n")
    assert [r.name for r in files.enabled(spark, str(tmp_path / "list")).orderBy("place").collect()] == ["a", "c"]
    (tmp_path / "rows.jsonl").write_text('{"id": "a"}\n{bad\n')
    assert [r.id for r in files.json_rows(spark, str(tmp_path / "rows.jsonl"), "id string", strict=False).where("id is not null").collect()] == ["a"]
    with pytest.raises(Exception):  # noqa: B017
        files.json_rows(spark, str(tmp_path / "rows.jsonl"), "id string", strict=True).collect()


def test_stream_gate_agrees_with_batch(spark, sf_dir, tmp_path):
    from tessera.operators.gates import best_of_group
    from tessera.streaming.gate import keep_winners, rejections

    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "value", "ts", F.when(F.col("event_type") == "error", "read_failed").alias("reason")).withColumn("passed", F.col("reason").isNull())
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = keep_winners(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["user_id"], "value", "event_id", "passed").trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = spark.read.parquet(str(tmp_path / "out" / "epoch=1"))
    want = best_of_group(events, ["user_id"], "value", "event_id", "passed")
    assert {(r.user_id, r.event_id) for r in last.collect()} == {(r.user_id, r.event_id) for r in want.collect()}
    q = rejections(stream, "ts", "reason", "1 hour").writeStream.outputMode("complete").format("memory").queryName("rejected").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(n) from rejected").first()[0] == events.where("reason is not null").count()
