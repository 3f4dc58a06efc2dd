"""The five stages of a curation run as DataFrame functions; manifests on disk are their borders.

Models are passed in as column functions (see functions.models.plug), so a
stage is the same plan whatever speaks, listens or writes sentences.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config, schema
from tessera.functions import models, signal, text
from tessera.functions.numbers import rounded
from tessera.operators import dedup, pairing, resume, sampling, verdict
from tessera.sources import audio, catalog, manifests

log = logging.getLogger("tessera")
Plug = Callable[[str], Column]


def acquire(spark: SparkSession, s: config.Acquisition, seed: int, out: str) -> DataFrame:
    """Catalogue, seeded selection and the clips' bytes; what is already there isn't pulled again."""
    bank = catalog.cached(spark, f"{out}/catalog", lambda: catalog.scan(spark, s.source, s.local_dir, s.languages, s.split), s.force_catalog)
    chosen = sampling.select_clips(bank, s.speakers_per_language, s.clips_per_speaker, seed, s.gender_balance, s.ref_min_dur, s.ref_max_dur)
    selection = sampling.selection_manifest(chosen, s.repo_id or s.local_dir, s.split)
    speakers = selection.select("lang", "speaker_id").distinct().count()
    if speakers < s.min_total_speakers:
        log.warning("%d speakers selected, fewer than the %d asked for", speakers, s.min_total_speakers)
    return catalog.pull_audio(spark, selection)


def with_files(clips: DataFrame, folder: str) -> DataFrame:
    """Pulled clips with their bytes also as files ref_audio/<ref_id><ext> under folder, named by local_audio_path."""
    named = clips.drop("local_audio_path").withColumns({"_file": F.concat("ref_id", "ext"), "_bytes": F.when(F.col("status") == "downloaded", F.col("content"))})
    return audio.write_blobs(named, f"{folder}/ref_audio", "_file", "_bytes", "local_audio_path").drop("_file")


def prepare(clips: DataFrame, s: config.Audio) -> DataFrame:
    """Decode, mix down, take off the offset, trim, cut, set the level, and say what was done."""
    d = clips.filter("status = 'downloaded'").withColumn("d", audio.decoded("content"))
    d = d.withColumns({"raw_peak": F.array_max(F.transform("d.samples", lambda f: signal.peak(f))), "x": signal.without_offset(signal.to_mono(F.col("d.samples")))})
    if s.trim:
        d = d.withColumn("_s", signal.loud_span(F.col("x"))).withColumn("x", F.slice("x", F.col("_s.first") + 1, F.col("_s.last") - F.col("_s.first"))).drop("_s")
    d = d.withColumn("seconds", F.size("x") / F.col("d.rate"))
    if s.max_ref_sec:
        d = d.withColumn("x", F.slice("x", F.lit(1), F.least(F.size("x"), (F.lit(s.max_ref_sec) * F.col("d.rate")).cast("int"))))
    level = signal.dbfs(signal.rms(F.col("x")))
    d = d.withColumn("qc_flags", signal.clip_flags(F.col("raw_peak"), F.col("d.rate"), s.target_sr, F.col("seconds"), s.max_ref_sec, level))
    d = d.withColumn("gain", signal.gain(F.col("x"), s.norm, s.peak_dbfs if s.norm == "peak" else s.rms_dbfs, s.peak_dbfs)).withColumn("y", signal.scaled(F.col("x"), F.col("gain")))
    made = d.select(
        "ref_id", "lang", "speaker_id", "gender", "ref_text", "duration", F.col("d.rate").alias("source_sr"), F.lit(s.target_sr).alias("target_sr"), F.col("d.channels").alias("channels_in"),
        F.lit(s.norm).alias("norm_method"), signal.dbfs(F.col("gain")).alias("gain_db"), signal.dbfs(signal.peak(F.col("y"))).alias("out_peak_dbfs"),
        signal.dbfs(signal.rms(F.col("y"))).alias("out_rms_dbfs"), "qc_flags", F.col("d.error").alias("error"), "y", F.col("d.rate").alias("own"),
    )
    made = audio.with_wav(made, "y", "own", s.target_sr, "prepared")
    good = F.col("prepared").isNotNull()
    return made.withColumns({"status": F.when(good, "prepared").otherwise("failed"), "error": F.coalesce("error", F.when(~good, "not fit to write"))})


def propose(spark: SparkSession, s: config.Sentences, generate: Plug) -> DataFrame:
    """Candidate sentences of every cell and attempt: seq, language, cell parts, text."""
    langs = spark.createDataFrame([(k, *v) for k, v in s.languages.items()], "language string, language_name string, script string")
    topics = spark.createDataFrame([(x,) for x in s.topics], "topic string")
    kinds = spark.createDataFrame([(x,) for x in s.sentence_types], "sentence_type string")
    cells = dedup.grid(langs, topics, kinds).crossJoin(spark.range(s.max_attempts_per_cell).withColumnRenamed("id", "attempt"))
    seeded = cells.withColumn("seed", text.seed(s.base_seed, F.col("language"), F.col("topic"), F.col("sentence_type"), F.col("attempt").cast("string")))
    asked = text.prompt(F.col("language_name"), F.col("script"), F.col("topic"), F.col("sentence_type"), F.lit(s.sentences_per_call))
    answered = seeded.withColumn("_g", generate(F.concat(asked, F.lit(" seed "), F.col("seed").cast("string"))))
    lines = answered.select("language", "language_name", "script", "topic", "sentence_type", "attempt", "seed", F.posexplode(text.parse_lines(F.col("_g.value"))).alias("pos", "text"))
    rank = F.concat_ws("|", "language", "topic", "sentence_type", F.lpad(F.col("attempt").cast("string"), 4, "0"), F.lpad(F.col("pos").cast("string"), 4, "0"))
    from pyspark.sql.window import Window

    return lines.withColumn("seq", F.row_number().over(Window.partitionBy("language").orderBy(rank)).cast("long"))


def sentence_pool(candidates: DataFrame, s: config.Sentences, embed: Plug | None = None, listen: Plug | None = None, earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted sentences, and every looked-at candidate's outcome.

    embed: unit vectors for the near-duplicate gate; listen: the language gate's
    label and confidence; without a model its gate is left out. earlier: the
    pool of an earlier run, which counts in its cells and stands in the way.
    """
    scripts = sorted({v[1] for v in s.languages.values()})
    said, rows = None, candidates
    if listen is not None:
        rows = rows.withColumn("_said", listen("text"))
        said = text.language_fault(F.col("_said.value"), F.col("language"), s.langid_min_conf)
    gates = lambda x: text.sentence_fault(F.col("text"), x, s.script_min_ratio, s.reject_unnormalized_numbers, s.min_words, s.max_words, s.min_type_token_ratio, said)
    cell = F.concat_ws("|", "language", "topic", "sentence_type")
    vector = lambda: F.lit(None).cast("array<float>") if embed is None else F.col("_v.value")
    judged = rows.withColumns({"fault": F.coalesce(*[F.when(F.col("script") == x, gates(x)) for x in scripts]), "key": text.dedup_key(F.col("text")), "cell": cell})
    judged = judged if embed is None else judged.withColumn("_v", embed(F.when(F.col("fault").isNull(), F.col("text"))))
    if earlier is not None:
        earlier = earlier.withColumns({"key": text.dedup_key(F.col("text")), "cell": cell})
        earlier = (earlier if embed is None else earlier.withColumn("_v", embed("text"))).withColumn("vector", vector())
    outcomes = dedup.accept_in_order(judged.withColumn("vector", vector()), s.per_cell_quota, s.near_dup_threshold, earlier)
    good = outcomes.filter("outcome = 'accepted'").select("seq", "language")
    pool = numbered(candidates.join(good, ["seq", "language"]), earlier)
    words = F.size(text.words(F.col("text")))
    return pool.select(*[F.col(c) for c in ("id", "language", "language_name", "topic", "sentence_type", "text")], words.alias("word_count"), F.length("text").alias("char_count"), "seed"), outcomes


def numbered(pool: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Adds id, the language and the sentence's number in the whole pool, in order of language and seq, on from an earlier pool's."""
    from pyspark.sql.window import Window

    own = F.row_number().over(Window.partitionBy("language").orderBy("seq"))
    counts = pool.groupBy("language").agg(F.count("*").alias("_n"))  # a row for each language
    before = F.sum("_n").over(Window.orderBy("language").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("language", F.coalesce(before, F.lit(0)).alias("_base"))
    start = 0 if earlier is None else earlier.count()
    n = F.col("_base") + F.col("_own") + F.lit(start - 1)
    placed = pool.withColumn("_own", own).join(F.broadcast(bases), "language")
    return placed.withColumn("id", F.concat(F.col("language"), F.lit("_"), F.lpad(n.cast("string"), 6, "0"))).drop("_own", "_base")


def speak(spark: SparkSession, sentences: DataFrame, prepared: DataFrame, s: config.Speech, synthesize: Plug) -> DataFrame:
    """Utterances with their samples: sentences paired with references, spoken chunk by chunk."""
    codes = spark.createDataFrame(list(s.lang_map.items()), "code string, name string")
    refs = pairing.with_code(prepared.filter("status = 'prepared'"), codes).select(F.col("code").alias("language"), "ref_id", "speaker_id", "gender", F.col("ref_id").alias("ref_audio_path"))
    pairs = pairing.round_robin(sentences.select("id", "language", "text", "topic", "sentence_type"), refs)
    spoken = pairs.withColumn("chunks", text.chunk(F.col("text"), s.max_chars)).select("*", F.posexplode("chunks").alias("n", "chunk")).withColumn("v", synthesize("chunk"))
    whole = spoken.groupBy("id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", F.col("v.value").alias("x")))), lambda c: c["x"])).alias("samples"), F.max("v.error").alias("error")
    )
    out = pairing.utterances(pairs).drop("status").join(whole.withColumnRenamed("id", "utt_id"), "utt_id")
    return out.withColumn("status", F.when(F.col("error").isNull(), "synthesized").otherwise("failed"))


def utterance_files(utterances: DataFrame, rate: int, folder: str) -> DataFrame:
    """utt_id and audio_filepath: the utterances' samples written as WAV files under folder, by the path that the manifest gives them."""
    rows = utterances.filter("status = 'synthesized'").select("utt_id", F.col("audio_filepath").alias("_file"), F.col("samples").alias("_x"), F.lit(rate).alias("_own"))
    made = audio.with_wav(rows, "_x", "_own", rate, "_wav")
    named = made.withColumn("_file", F.substring_index("_file", "/", -1))
    return audio.write_blobs(named, f"{folder}/audio", "_file", "_wav", "audio_filepath").drop("_file")


def reference_samples(prepared: DataFrame) -> DataFrame:
    """ref_id and samples of every prepared clip, mono."""
    d = prepared.filter("status = 'prepared'").select("ref_id", audio.decoded("prepared").alias("d"))
    return d.select("ref_id", signal.to_mono(F.col("d.samples")).alias("samples"))


def voice_similarity(utterances: DataFrame, references: DataFrame, encode: Plug) -> DataFrame:
    """Adds speaker_sim, the cosine of an utterance's voice and its reference's; null without a reference.

    references: (ref_id, samples), one row for each reference clip.
    """
    voices = references.select("ref_id", encode("samples").alias("_r")).select("ref_id", F.col("_r.value").alias("_ref"))
    joined = utterances.join(voices, "ref_id", "left").withColumn("_own", encode("samples"))
    both = F.col("_own.value").isNotNull() & F.col("_ref").isNotNull()
    return joined.withColumn("speaker_sim", F.when(both, signal.cosine(F.col("_own.value"), F.col("_ref")))).drop("_own", "_ref")


def certify(utterances: DataFrame, s: config.Quality, rate: int, transcribe: Plug | None = None, similarity: Column | None = None) -> DataFrame:
    """Every check on every utterance; it passes if none fails. similarity: a column, by default speaker_sim if there is one."""
    if similarity is None and "speaker_sim" in utterances.columns:
        similarity = F.col("speaker_sim")
    u = utterances.filter("status = 'synthesized'").withColumn("x", F.transform("samples", lambda v: v.cast("double")))
    u = u.withColumn("levels", signal.frame_rms(F.col("x"), int(rate * 0.025), int(rate * 0.010)))
    u = u.withColumn("duration", F.size("x") / F.lit(rate))
    x, levels = F.col("x"), F.col("levels")
    level, spc = signal.clamped_dbfs(signal.rms(x)), text.seconds_per_char(F.col("duration"), F.col("text"))
    clipped, tail = signal.clipped_share(x, s.clip_sample_thresh), signal.tail_ratio(levels, max(1, int(s.trunc_tail_ms / 10)))
    checks = [
        verdict.check("silence", (level >= s.silence_rms_dbfs) & (signal.active_share(levels, s.silence_rms_dbfs) >= s.silence_active_frac_min), rounded(level, 2)),
        verdict.check("clipping", (clipped <= s.clip_frac_max) & (signal.longest_run(x, s.clip_sample_thresh) < s.clip_run_max), rounded(clipped, 6)),
        verdict.check("truncation", F.coalesce(tail <= s.trunc_tail_ratio, F.lit(True)), rounded(F.coalesce(tail, F.lit(0.0)), 3)),
        verdict.check("dur_per_char", F.coalesce(spc.between(s.dur_per_char_min, s.dur_per_char_max), F.lit(False)), rounded(spc, 4)),
    ]
    if s.loop_band_frac <= 1:
        loops = models.plug(partial(models.looping_share, rate, s.loop_min_lag_s, s.loop_pair_sim), "double")
        u = u.withColumn("_l", loops("samples")).withColumn("_loop", F.col("_l.value")).drop("_l")
        checks.append(verdict.check("looping_audio", F.col("_loop") < s.loop_band_frac, rounded("_loop", 3)))
    if transcribe is not None and s.run_asr:
        u = u.withColumn("_t", transcribe("text")).withColumn("asr_transcript", F.col("_t.value")).drop("_t")
        cer = text.character_error_rate(text.score_text(F.col("text")), text.score_text(F.col("asr_transcript")))
        u = u.withColumns({"cer": cer, "_r": text.consecutive_repeats(F.col("asr_transcript"))})
        checks.append(verdict.check("cer", F.coalesce(F.col("cer") <= s.cer_max, F.lit(False)), F.col("cer")))
        checks.append(verdict.check("looping_text", F.col("_r") < s.text_repeat_ngram, F.col("_r")))
    if similarity is not None and s.run_speaker:
        checks.append(F.when(similarity.isNotNull(), verdict.check("speaker_cos", similarity >= s.spk_cos_min, similarity)))
    return verdict.with_verdict(u, *checks).drop("x", "levels", "_r", "_loop", "samples").withColumn("status", F.lit("validated"))


def certify_new(
    spark: SparkSession, utterances: DataFrame, path: str, s: config.Quality, rate: int, transcribe: Plug | None = None, references: DataFrame | None = None, encode: Plug | None = None
) -> DataFrame:
    """Certify what the dataset manifest at path doesn't hold yet, append it, and give the whole manifest.

    references and encode, the voices and a model of them, are for the speaker check.
    """
    kind = schema.DATASET
    done = resume.done_keys(manifests.read(spark, path, kind), "utt_id")
    fresh = resume.pending(utterances, done, "utt_id")
    if s.run_speaker and references is not None and encode is not None:
        fresh = voice_similarity(fresh, references, encode)
    fresh = certify(fresh, s, rate, transcribe)
    manifests.append(fresh.select(*[F.col(f.name) if f.name in fresh.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]), path)
    return manifests.read(spark, path, kind)
