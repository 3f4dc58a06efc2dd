"""The whole run on small files with stand-in models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import config
from tessera.functions import models
from tessera.plans import cli, stages
from tessera.sources import audio


@pytest.fixture
def bank(spark, tmp_path):
    clip = audio.encode_wav(0.1 * np.sin(np.arange(4000) * 2 * np.pi * 220 / 16000), 16000)
    for lang in ("hindi", "malayalam"):
        rows = [(f"{i}.wav", f"text {i}", (bytearray(clip), f"{i}.wav"), 4.0, "m" if i % 2 else "f", i % 4) for i in range(8)]
        spark.createDataFrame(rows, "fname string, text string, audio_filepath struct<bytes: binary, path: string>, duration double, gender string, speaker_id long").coalesce(1).write.parquet(f"{tmp_path}/raw-{lang}")
        (tmp_path / lang).mkdir()
        next((tmp_path / f"raw-{lang}").glob("part-*.parquet")).rename(tmp_path / lang / "valid-0.parquet")
    return tmp_path


def test_run(spark, bank):
    clips = stages.acquire(spark, config.Acquisition(local_dir=str(bank), languages=["hindi", "malayalam"], speakers_per_language=2, clips_per_speaker=2), 7, f"file://{bank}/out").cache()
    assert clips.filter("status = 'downloaded'").count() == 8
    ready = stages.prepare(clips, config.Audio(trim=True)).cache()
    rows = ready.collect()
    assert all(r.status == "prepared" and r.target_sr == 24000 and "resampled_up" in r.qc_flags and r.out_peak_dbfs <= 0 for r in rows)
    assert audio.decode_wav(bytes(rows[0].prepared))[1] == 24000
    s = config.Sentences(languages={"hi": ["Hindi", "Latin"], "ml": ["Malayalam", "Latin"]}, topics=["t"], sentence_types=["statement"], per_cell_quota=2, max_attempts_per_cell=3)
    pool, outcomes = stages.sentence_pool(stages.propose(spark, s, models.plug(models.stub_generator, "string")), s)
    pool = pool.cache()
    assert {r["count"] for r in pool.groupBy("language").count().collect()} == {2}
    assert outcomes.filter("outcome = 'accepted'").count() == 4
    said = stages.speak(spark, pool, ready, config.Speech(), models.plug(models.stub_synthesizer, "array<float>")).cache()
    assert said.count() == 4 and said.filter("status = 'synthesized'").count() == 4
    assert said.join(ready.select("ref_id", F.substring("lang", 1, 1).alias("l")), "ref_id").filter(F.substring("language", 1, 1) != F.col("l")).count() == 0
    done = stages.certify_new(spark, said, f"{bank}/dataset", config.Quality(), 16000, models.plug(models.stub_transcriber, "string"))
    got = done.collect()
    assert len(got) == 4 and all([c.name for c in r.qc_checks] == ["silence", "clipping", "truncation", "dur_per_char", "cer", "looping_text"] for r in got)
    assert all(r.qc_reasons == ["truncation"] for r in got)  # the stand-in's tone stops at full level
    assert stages.certify_new(spark, said, f"{bank}/dataset", config.Quality(), 16000).count() == 4


@pytest.fixture
def clean_bank(spark, bank):
    return config.Acquisition(local_dir=str(bank), languages=["hindi", "malayalam", "none"], speakers_per_language=2, clips_per_speaker=2)


def test_files_and_warnings(spark, bank, clean_bank, caplog):
    """Clips are files named by their manifest; too few speakers and a language without files are said."""
    caplog.set_level("WARNING", "tessera")
    clips = stages.acquire(spark, clean_bank, 7, f"file://{bank}/out").cache()
    kept = stages.with_files(clips, f"{bank}/files").collect()
    assert len(kept) == 8 and all(audio.decode_wav(open(r.local_audio_path, "rb").read())[1] == 16000 and r.local_audio_path.endswith(f"{r.ref_id}.wav") for r in kept)
    assert "4 speakers" in caplog.text and "none" in caplog.text
    utterances = spark.createDataFrame([("u1", "audio/u1.wav", [0.1] * 400, "synthesized"), ("u2", "audio/u2.wav", [5.0], "synthesized"), ("u3", "audio/u3.wav", None, "failed")], "utt_id string, audio_filepath string, samples array<float>, status string")
    paths = {r.utt_id: r.audio_filepath for r in stages.utterance_files(utterances, 16000, str(bank)).collect()}
    assert paths == {"u1": f"{bank}/audio/u1.wav", "u2": None} and len(audio.decode_wav(open(paths["u1"], "rb").read())[0]) == 400


def test_pull_moves_no_audio_but_the_selected(spark, bank, clean_bank):
    clips = stages.acquire(spark, clean_bank, 7, f"file://{bank}/out")
    plan = clips._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan or "rightHint=(strategy=broadcast)" in plan
    wider = config.Acquisition(**{**vars(clean_bank), "ref_min_dur": 5.0, "ref_max_dur": 9.0})
    assert stages.acquire(spark, wider, 7, f"file://{bank}/out").count() == 0
    raw = spark.createDataFrame([("x", bytearray(b"RIFF0000WAVE"))], "fname string, audio_filepath binary")
    raw.coalesce(1).write.parquet(f"{bank}/bytes")
    path = next((bank / "bytes").glob("part-*.parquet")).as_uri().replace("file:///", "file:/")
    one = spark.createDataFrame([("r", path, 0, "selected"), ("s", path, 9, "selected")], "ref_id string, source_file string, row_index long, status string")
    from tessera.sources import catalog

    assert {(r.ref_id, r.status, r.ext) for r in catalog.pull_audio(spark, one).collect()} == {("r", "downloaded", ".wav"), ("s", "failed", ".bin")}


def gated(spark, s, lines, **models_given):
    rows = [(i, "en", "English", "Latin", "t", "statement", 0, 1, line) for i, line in enumerate(lines)]
    kind = "seq long, language string, language_name string, script string, topic string, sentence_type string, attempt long, seed long, text string"
    pool, outcomes = stages.sentence_pool(spark.createDataFrame(rows, kind), s, **models_given)
    return {r.seq: r.outcome for r in outcomes.collect()}, sorted((r.id, r.text) for r in pool.collect())


def test_settings_of_the_pool_count(spark):
    """Each setting changes the outcome that it is for."""
    lines = ["the cat sat on the mat today", "the cat sat on the mat now", "one two three", "der hund und die katze in haus", "all of it and the rest", "a b a b a b c d"]
    base = {"languages": {"en": ["English", "Latin"]}, "topics": ["t"], "sentence_types": ["statement"]}
    outcomes = lambda given=None, **more: gated(spark, config.Sentences(**base, **more), lines, **(given or {}))[0]
    assert outcomes()[2] == "too_short" and outcomes()[0] == outcomes()[1] == "accepted"
    assert outcomes(min_words=3)[2] == "accepted" and outcomes(max_words=6)[0] == "too_long" and outcomes(min_type_token_ratio=0.9)[0] == "low_diversity"
    embed = {"embed": models.plug(models.stub_embedder, "array<float>")}
    assert outcomes(embed, near_dup_threshold=0.7)[1] == "near_duplicate" and outcomes(embed, near_dup_threshold=0.999)[1] == "accepted"
    listen = {"listen": models.plug(models.stub_language, models.SAID)}
    assert outcomes(listen)[3] == "langid_mismatch:de" and outcomes(listen, langid_min_conf=0.5)[4] == "accepted"
    assert outcomes(listen, langid_min_conf=1.0)[4] == "accepted" and outcomes(listen)[0] == "accepted"


def test_a_pool_goes_on_from_an_earlier_one(spark):
    s = config.Sentences(languages={"en": ["English", "Latin"]}, topics=["t"], sentence_types=["statement"], per_cell_quota=3)
    lines = ["the cat sat on the mat today", "some other words stand here now", "the cat sat, on the mat today", "this one is quite new here", "and this one is late too"]
    earlier = spark.createDataFrame([("en", "t", "statement", "the cat sat on the mat today")], "language string, topic string, sentence_type string, text string")
    outcomes, pool = gated(spark, s, lines, embed=models.plug(models.stub_embedder, "array<float>"), earlier=earlier)
    assert outcomes == {0: "exact_duplicate", 1: "accepted", 2: "exact_duplicate", 3: "accepted"}
    assert pool == [("en_000001", lines[1]), ("en_000002", lines[3])]


def test_loop_and_speaker_checks(spark):
    rate, rng = 8000, np.random.default_rng(2)
    noise = rng.normal(size=2 * rate) * 0.1
    loop = np.tile(rng.normal(size=rate // 2) * 0.1, 4)
    share = models.looping_share(rate, 0.3, 0.99)
    assert share(loop) > 0.8 > 0.3 > share(noise) and share([0.0] * 10) == 0.0
    rows = [("a", "r1", loop.tolist(), "x y", "synthesized"), ("b", "r2", noise.tolist(), "x y", "synthesized"), ("c", "none", noise.tolist(), "x y", "synthesized")]
    said = spark.createDataFrame(rows, "utt_id string, ref_id string, samples array<double>, text string, status string")
    tone = np.sin(np.arange(rate) / 3)
    refs = spark.createDataFrame([("r1", loop.tolist()), ("r2", tone.tolist())], "ref_id string, samples array<double>")
    sims = stages.voice_similarity(said, refs, models.plug(models.stub_speaker, "array<double>"))
    got = {r.utt_id: {c.name: c.passed for c in r.qc_checks} for r in stages.certify(sims, config.Quality(loop_band_frac=0.6, spk_cos_min=0.9), rate).collect()}
    assert got["a"]["looping_audio"] is False and got["b"]["looping_audio"] is True and got["a"]["speaker_cos"] is True and got["b"]["speaker_cos"] is False
    assert "speaker_cos" not in got["c"] and "looping_audio" not in {c.name for r in stages.certify(said, config.Quality(), rate).collect() for c in r.qc_checks}


def test_run_writes_summaries_and_a_report(spark, bank):
    """The command line's five stages, each with its summary, and the report."""
    import json
    import logging

    raw = {
        "seed": 7, "out_dir": f"{bank}/run", "data_acquisition": {"local_dir": str(bank), "languages": ["hindi", "malayalam"], "speakers_per_language": 2, "clips_per_speaker": 2, "retry_backoff": 0.0},
        "sentence_generation": {"languages": {"hi": ["Hindi", "Latin"], "ml": ["Malayalam", "Latin"]}, "topics": ["t"], "sentence_types": ["statement"], "per_cell_quota": 2, "max_attempts_per_cell": 3},
        "tts_generation": {"lang_map": {"hi": "hindi", "ml": "malayalam"}},
    }
    assert config.faults(raw) == ([], [])
    took = cli.run(raw, cli.ORDER, logging.getLogger("test"))
    assert list(took) == cli.ORDER
    for name in cli.ORDER:
        assert json.load(open(f"{bank}/run/{name}_summary.json"))["elapsed_s"] == took[name]
    assert json.load(open(f"{bank}/run/data_acquisition_summary.json"))["counts"] == {"downloaded": 8}
    assert json.load(open(f"{bank}/run/pipeline_summary.json")) == took
    report = open(f"{bank}/run/report.md").read()
    assert all(f"## {x}" in report for x in ("Sentences", "Datacard", "Languages", "Distributions", "Checks")) and "speaker_cos" in report
    assert len(list((bank / "run" / "ref_audio").glob("*.wav"))) == 8 and len(list((bank / "run" / "audio").glob("*.wav"))) >= 2
    from tessera.sources import manifests

    (bank / "bad.json").write_text("{not json")
    assert manifests.read_summary(spark, f"{bank}/bad.json") is None and manifests.read_summary(spark, f"{bank}/none.json") is None
    assert manifests.read_summary(spark, f"{bank}/run/pipeline_summary.json") == took


def test_bad_clips_fail_alone(spark):
    clips = spark.createDataFrame([("a", "x", 1, "m", "t", 1.0, bytearray(b"junk"), "downloaded")], "ref_id string, lang string, speaker_id long, gender string, ref_text string, duration double, content binary, status string")
    r = stages.prepare(clips, config.Audio()).first()
    assert r.status == "failed" and r.error


def test_command_line(tmp_path):
    bad = tmp_path / "bad.yaml"
    bad.write_text("seed: -1\n")
    good = tmp_path / "good.yaml"
    good.write_text("seed: 1\nout_dir: x\n")
    assert cli.main(["--config", str(bad)]) == 2 and cli.main(["--config", str(good), "--validate-only"]) == 0
    calls = []
    with pytest.raises(ZeroDivisionError):
        cli.with_retries(lambda: calls.append(1) or 1 / 0, 2, 0)
    assert len(calls) == 2
