"""Literal cases of text gates, signals, audio, settings, manifests and resume."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera import config, schema
from tessera.functions import models, signal, text
from tessera.operators import dedup, pairing, resume, sampling, verdict
from tessera.sources import audio, catalog, manifests
from tessera.streaming import ingest


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<double>' if isinstance(v, list) else 'double'}" for k, v in values.items()))
    return frame.select(column.alias("r")).first().r


@pytest.mark.parametrize(("sentence", "script", "ratio"), [("आज मौसम अच्छा है", "Devanagari", 1.0), ("hello world", "Devanagari", 0.0), ("...", "Latin", 0.0), ("ab आज", "Latin", 0.5)])
def test_script_ratio(spark, sentence, script, ratio):
    assert one(spark, text.script_ratio(F.col("s"), script), s=sentence) == ratio


@pytest.mark.parametrize(("sentence", "fault"), [
    ("", "empty"), (None, "empty"), ("नमस्ते", "too_short"), ("राम राम राम राम राम", "low_diversity"), ("a b b c d e", "repeated_word"), ("a b c x a b c y", "repeated_ngram"),
    ("मेरे पास अभी बस 5 रुपये", "unnormalized_number"), ("₹ सौ रुपये मेरे पास हैं", "unnormalized_number"), ("this is all in latin", "wrong_script"), ("मेरे पास अभी बस सौ रुपये", None), (" ".join("abcdefghijklmnopqrstu"), "too_long"),
])
def test_sentence_fault(spark, sentence, fault):
    assert one(spark, text.sentence_fault(F.col("s"), "Devanagari"), s=sentence) == fault


def test_keys_and_scores(spark):
    key = lambda s: one(spark, text.dedup_key(F.col("s")), s=s)
    assert key("आज,  मौसम!") == key("आज मौसम") and key("a , b") == "a  b" and key("café") == "café"
    cer = lambda a, b: one(spark, text.character_error_rate(text.score_text(F.col("a")), text.score_text(F.col("b"))), a=a, b=b)
    assert cer("kitten", "sitting") == 0.5 and cer("", "x") == 1.0 and cer("", "") == 0.0 and cer("राम।", "राम") == 0.0 and cer("a", "bcd") == 3.0


def test_lines_and_chunks(spark):
    lines = one(spark, text.parse_lines(F.col("s")), s='- 1. "one two"\n\n 2) “three”\n* four')
    assert lines == ["one two", "three", "four"]
    long = " ".join(f"Sentence number {i}." for i in range(60))
    chunks = one(spark, text.chunk(F.col("s"), 100), s=long)
    assert max(map(len, chunks)) <= 100 and " ".join(chunks) == long
    assert one(spark, text.chunk(F.col("s"), 5), s="longer than five. b.") == ["longer than five.", "b."]
    assert one(spark, text.consecutive_repeats(F.col("s")), s="राम " * 5) == 5
    assert one(spark, text.consecutive_repeats(F.col("s")), s="x a b a b a b") == 2


def test_seed_is_sha256(spark):
    import hashlib

    want = int(hashlib.sha256(b"1234|a|b").hexdigest()[:8], 16)
    assert one(spark, text.seed(1234, F.col("a"), F.col("b")), a="a", b="b") == want


def test_prompt(spark):
    row = spark.range(1).select(text.prompt(F.lit("Hindi"), F.lit("Devanagari"), F.lit("travel"), F.lit("question"), F.lit(4)).alias("p")).first()
    assert "4 different question sentences in Hindi" in row.p


def test_signal(spark):
    rng = np.random.default_rng(1)
    speech = (0.6 * rng.uniform(-1, 1, 400) * np.concatenate([np.ones(300), np.linspace(1, 0, 100) ** 3])).tolist()
    levels = lambda c: signal.frame_rms(c, 20, 8)
    x = F.col("x")
    assert one(spark, signal.tail_ratio(levels(x)), x=speech) < 0.6 < one(spark, signal.tail_ratio(levels(x)), x=speech[:250])
    frames = [np.sqrt(np.mean(np.square(speech[i : i + 20])) + 1e-12) for i in range(0, 381, 8)]
    assert np.allclose(one(spark, levels(x), x=speech), frames)
    assert np.isclose(one(spark, signal.percentile(levels(x), 0.95), x=speech), np.percentile(frames, 95))
    assert one(spark, signal.clamped_dbfs(signal.rms(x)), x=[0.0] * 30) < -100 and one(spark, signal.dbfs(signal.peak(x)), x=[0.0]) is None
    assert one(spark, signal.longest_run(x, 0.99), x=[1.0, -1.0, 0.0, 1.0]) == 2 and one(spark, signal.clipped_share(x, 0.99), x=[1.0, 0.0]) == 0.5
    assert np.isclose(one(spark, signal.peak(signal.scaled(x, signal.gain(x, "peak", -1.0))), x=speech), 10 ** (-1 / 20))
    assert one(spark, signal.gain(x, "rms", -20.0), x=[0.0, 0.0]) == 1.0
    with pytest.raises(ValueError):
        signal.gain(x, "lufs", -20.0)
    padded = [0.0] * 50 + [0.5] * 40 + [0.0] * 50
    span = one(spark, signal.loud_span(x, 8, 4), x=padded)
    assert span.first <= 50 and span.last >= 90 and span.last - span.first < 60
    assert one(spark, signal.sound_ok(x), x=[0.5]) and not one(spark, signal.sound_ok(x), x=[2.0]) and not one(spark, signal.sound_ok(x), x=[])
    stereo = spark.createDataFrame([([[1.0, 0.0], [0.5, 0.5]], [16384])], "c array<array<double>>, i array<int>").select(signal.to_mono(F.col("c")).alias("m"), signal.from_int16(F.col("i")).alias("f")).first()
    assert stereo.m == [0.5, 0.5] and stereo.f == [0.5]


def test_audio_round_trip(spark):
    tone = 0.5 * np.sin(np.arange(1600) / 10)
    good = audio.encode_wav(tone, 16000)
    frame = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"RIFFbroken"))], "id int, b binary")
    rows = {r.id: r.d for r in frame.select("id", audio.decoded("b").alias("d")).collect()}
    assert rows[1].rate == 16000 and rows[1].channels == 1 and np.allclose(np.ravel(rows[1].samples), tone, atol=1e-3) and rows[2].error
    mono = frame.filter("id = 1").select(audio.decoded("b").alias("d")).select(signal.to_mono(F.col("d.samples")).alias("x"), F.col("d.rate").alias("own"))
    again = audio.with_wav(mono, "x", "own", 24000, "w").first().w
    data, rate = audio.decode_wav(bytes(again))
    assert rate == 24000 and len(data) == 2400
    with pytest.raises(ValueError):
        audio.encode_wav(np.array([3.0]), 16000)


def test_voice_bank(spark, tmp_path):
    """Scan, select, pull, resume: the acquisition stage on small files."""
    clip = audio.encode_wav(0.1 * np.sin(np.arange(400)), 16000)
    for lang in ("hindi", "tamil"):
        rows = [(f"{i}.wav", f"text {i}", (bytearray(clip), f"{i}.wav" if i % 2 else None), 4.0, "MALE" if i % 2 else " f ", i // 3) for i in range(12)]
        frame = spark.createDataFrame(rows, "fname string, text string, audio_filepath struct<bytes: binary, path: string>, duration double, gender string, speaker_id long")
        frame.coalesce(1).write.parquet(f"{tmp_path}/raw-{lang}")
        (tmp_path / lang).mkdir()
        next((tmp_path / f"raw-{lang}").glob("part-*.parquet")).rename(tmp_path / lang / "valid-0.parquet")
    bank = catalog.scan(spark, "local", str(tmp_path), ["hindi", "tamil", "none"])
    assert "audio_filepath" not in bank._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    chosen = sampling.select_clips(bank, 2, 2, 1)
    manifest = sampling.selection_manifest(chosen, "bank", "valid").cache()
    assert manifest.count() == 8 and manifest.select("speaker_id", "lang").distinct().count() == 4
    pulled = catalog.pull_audio(spark, manifest)
    assert {(r.status, r.ext) for r in pulled.collect()} == {("downloaded", ".wav")}
    done = resume.done_keys(pulled, "ref_id", "downloaded")
    assert resume.pending(manifest, done, "ref_id").count() == 0
    with pytest.raises(ValueError):
        catalog.scan(spark, "local", str(tmp_path), ["none"])
    with pytest.raises(ValueError):
        catalog.files_of("ftp", "", "", "")
    path = f"file://{tmp_path}/catalog"
    assert catalog.cached(spark, path, lambda: bank).count() == 24 == catalog.cached(spark, path, lambda: 1 / 0).count()


def test_sampling_contract(spark):
    rows = [("x", i, "male" if i < 2 else "female" if i < 9 else "other") for i in range(14)]
    speakers = spark.createDataFrame(rows, "lang string, speaker_id long, gender string")
    got = sampling.stratified_speakers(speakers, 7, 5).toPandas()
    assert len(got) == 7 and (got.gender == "male").sum() == 2 and (got.gender == "female").sum() >= 3
    assert set(got.speaker_id) == set(sampling.stratified_speakers(speakers.repartition(5), 7, 5).toPandas().speaker_id)
    assert sampling.stratified_speakers(speakers, 50, 5).count() == 14 and sampling.stratified_speakers(speakers, 3, 5, balance=False).count() == 3


def test_manifests(spark, tmp_path):
    path = f"{tmp_path}/m"
    rows = spark.createDataFrame([("a", "downloaded"), ("b", "failed")], "ref_id string, status string")
    kind = schema.of("ref_id string, status string")
    assert manifests.read(spark, path, kind).count() == 0
    manifests.write(rows, path)
    manifests.append(rows.withColumn("status", F.lit("downloaded")), path)
    assert manifests.read(spark, path, kind).count() == 4
    with open(f"{path}/part-broken.json", "w") as f:
        f.write('{"ref_id": "c", "status": "downloaded"}\n\n{"ref_id": \n')
    assert manifests.read(spark, path, kind, tolerant=True).count() == 5
    with pytest.raises(Exception):
        manifests.read(spark, path, kind).collect()
    assert resume.done_keys(manifests.read(spark, path, kind, tolerant=True), "ref_id", "downloaded").count() == 3
    todo = spark.createDataFrame([("a",), ("z",)], "ref_id string")
    done = f"{tmp_path}/done"
    assert [ingest.resume_batch(spark, todo, "ref_id", done, kind, lambda d: d.withColumn("status", F.lit("ok"))) for _ in range(2)] == [2, 0]


def test_stream_counts(spark, tmp_path):
    kind = schema.of("id long, reason string")
    spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], kind).write.json(f"{tmp_path}/in")
    q = ingest.rejection_counts(spark, f"{tmp_path}/in", kind, "reasons", f"{tmp_path}/state")
    q.awaitTermination()
    assert [(r.reason, r["count"]) for r in spark.sql("SELECT * FROM reasons").collect()] == [("a", 2)]


def test_settings():
    assert config.faults({"seed": 1, "data_acquisition": {"ref_min_dur": 3, "ref_max_dur": 15}, "quality_control": {"loop_band_frac": 1.01}}) == ([], [])
    errors, warnings = config.faults({
        "seed": -1, "data_acquisition": {"source": "ftp", "languages": [], "speakers_per_language": True, "typo": 1, "ref_min_dur": 9.0, "ref_max_dur": 3.0},
        "sentence_generation": {"min_words": 9, "max_words": 5}, "tts_generation": {"lang_map": {"a": "x", "b": "x"}}, "quality_control": {"cer_max": 2},
    })
    assert len(errors) == 8 and warnings == ["data_acquisition.typo: unknown"]
    made = config.stage({"seed": 9, "sentence_generation": {"min_words": None, "what": 1}}, "sentence_generation")
    assert made.base_seed == 9 and made.min_words == 5
    assert config.public(config.Acquisition(hf_token="secret"))["hf_token"] == "***"


def test_verdict_and_pairs(spark):
    rows = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.1, None)], "utt_id long, cer double, sim double")
    out = verdict.with_verdict(rows, verdict.check("cer", F.col("cer") <= 0.15, F.col("cer"), F.lit("x")), F.when(F.col("sim").isNotNull(), verdict.check("speaker_cos", F.col("sim") >= 0.6, F.col("sim"))))
    got = {r.utt_id: (r.qc_passed, r.qc_reasons) for r in out.collect()}
    assert got == {1: (False, ["cer(x)", "speaker_cos"]), 2: (True, [])}
    assert out.select(verdict.metric("speaker_cos").alias("m")).collect()[0].m == 0.1
    refs = spark.createDataFrame([("hi", "r2"), ("hi", "r1")], "language string, ref_id string")
    sents = spark.createDataFrame([("hi", f"s{i}") for i in range(4)] + [("ml", "m")], "language string, id string")
    assert {(r.id, r.ref_id) for r in pairing.round_robin(sents, refs).collect()} == {("s0", "r1"), ("s1", "r2"), ("s2", "r1"), ("s3", "r2")}


def test_stubs():
    assert models.stub_generator()("p") == models.stub_generator()("p")
    assert models.stub_language({"en": {"the"}, "de": {"der"}})("the cat") == {"label": "en", "confidence": 1.0} and models.stub_transcriber()("ab.") == "ab"
    assert len(models.resample(np.ones(100), 16000, 24000)) == 150 and len(models.resample(np.ones(100), 16000, 8000)) == 50


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.sampled_from(["seed", "quality_control", "x"]), st.one_of(st.integers(), st.dictionaries(st.text(max_size=4), st.integers(), max_size=3))))
def test_settings_never_crash(raw):
    config.faults(raw)


def test_first_of_each(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "seq long, key string")
    assert {(r.seq, r.key) for r in dedup.first_of_each(rows, ["key"], ["seq"]).collect()} == {(1, "a"), (3, "b")}


def test_rounding_is_that_of_the_sql(spark):
    """Halves as DuckDB rounds them: by the scaled double, not by its shortest decimal."""
    import duckdb

    from tessera.functions.numbers import rounded

    values = [0.07125, 9.12 / 128, 26.5 / 3, -0.07125, 0.0, None, 1e-9, 3.28 / 320, *[k * 0.08 / n for k in range(1, 60) for n in (80, 128, 320, 1600)]]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded("v", 4).alias("x")).collect()]
    con = duckdb.connect()
    assert got == [con.execute("SELECT round(?::DOUBLE, 4)", [v]).fetchone()[0] for v in values]


def test_utterance_checks_at_their_bounds_are_those_of_the_sql(spark, tmp_path):
    """Lengths in ratios of 1 to 2 and 15 to 4 stand at the bounds of dur_per_char; sums of durations are exact."""
    import duckdb

    from tessera import queries as Q

    sizes = [(138, 69), (228, 114), (116, 435), (12, 45), (4, 15), (128, 114), (320, 41), (50, 50), (136, 68), (76, 285)]
    rows = [(k, turn, "user", "x" * n) for k, pair in enumerate(sizes) for turn, n in enumerate(pair)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    for name in ("dur_per_char", "check_flatten", "qc_verdict", "datacard", "per_language", "per_speaker", "failure_reasons", "qc_breakdown", "check_metrics", "distributions"):
        got, want = Q.QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(Q.ORACLE[name]).df()
        columns = sorted(want.columns)
        assert sorted(map(repr, got[columns].astype(object).values.tolist())) == sorted(map(repr, want[columns].astype(object).values.tolist())), name


def test_edit_distance_is_worked_out_once_for_each_row(spark):
    """Of the plain distance, and in one place of the plan, however many checks and filters use it."""
    import random

    from tessera import queries as Q
    from tests.test_queries import plain_distance

    r = random.Random(3)
    pairs = [tuple("".join(r.choice("abé 𝒳") for _ in range(r.randint(0, 80))) for _ in range(2)) for _ in range(80)] + [("", "ab"), ("ab", ""), ("", ""), (None, "a"), ("a", None)]
    found = spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.levenshtein("a", "b").alias("d")).collect()
    assert [x.d for x in found] == [None if x.a is None or x.b is None else plain_distance(x.a, x.b) for x in found]
    for name in ("distributions", "failure_reasons", "check_metrics"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        plan = plan.partition("== Initial Plan ==")[2] or plan
        assert len([x for x in plan.splitlines() if "ArrowEvalPython" in x]) == 1, name


def test_parse_lines_has_the_rows_of_its_sql(spark, tmp_path):
    """Odd line ends, white space and quotes; the stage's own form takes off white space of any kind."""
    import random

    import duckdb

    from tessera import queries as Q

    r = random.Random(7)
    bits = ["a", "word", " ", "\n", "\r", "\r\n", "\t", "\x0b", "\x0c", "\x85", " ", " ", "\xa0", "　", "﻿", '"', "“", "”", "-", "*", "•", "1.", "2)", "٣.", "é", "𝒳", "\x1c"]
    rows = [(k, "".join(r.choice(bits) for _ in range(r.randint(0, 14)))) for k in range(3000)] + [(3000, None), (3001, ' said" \n " x "')]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = {(x.doc_id, x.n, x.heads) for x in Q.QUERIES["parse_lines"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(Q.ORACLE["parse_lines"]).fetchall())
    assert one(spark, text.parse_lines(F.col("s")), s='" x " \xa0y') == ["x", "y"]


def test_models_hand_results_on_by_their_size(spark):
    import pandas as pd

    from tessera.functions import models

    voice = models.plug(models.stub_synthesizer, "array<float>")
    frames = list(voice.func(iter([pd.Series(["x" * 300, ""] * 20), pd.Series([], dtype=object), pd.Series(["ab"])])))
    assert max(sum(len(v) for v in f["value"] if v) for f in frames) <= models.HELD + 300 * 960
    whole = pd.concat(frames)
    assert [v and len(v) for v in whole["value"]] == [288000, None] * 20 + [1920]
    assert whole["error"].notna().tolist() == [False, True] * 20 + [False]


def test_places_in_runs(spark, monkeypatch):
    """Places by id, found in many runs; a run holds a part of its language."""
    from tessera.operators import pairing

    monkeypatch.setattr(pairing, "RUN_ROWS", 40)
    ids = {"a": [f"s{k * 7919 % 5000:05d}" for k in range(1500)], "b": [f"é{k}" for k in range(300)], "none": ["x1"]}
    sents = spark.createDataFrame([(lang, i, "t") for lang, own in ids.items() for i in own], "language string, id string, text string")
    got = {(r.language, r.id): r._k for r in pairing.in_places(sents, "language", "id").collect()}
    assert got == {(lang, i): k for lang, own in ids.items() for k, i in enumerate(sorted(own))}
    refs = spark.createDataFrame([("a", f"r{k}") for k in range(3)] + [("b", "q"), (None, "z")], "language string, ref_id string")
    found = pairing.round_robin(sents, refs)
    assert {(r.language, r.id): r.ref_id for r in found.collect()} == {(lang, i): f"r{k % 3}" if lang == "a" else "q" for lang in "ab" for k, i in enumerate(sorted(ids[lang]))}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "row_number" in x and "Window [" in x and "id#" in x.split("Window")[1] and "ref_id" not in x.split("Window")[1]]
    assert windows and all("_run" in x for x in windows)
