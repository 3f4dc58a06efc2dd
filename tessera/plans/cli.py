"""python -m tessera.plans.cli --config settings.yaml [--stages ...] [--validate-only] [--no-validate]"""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time

from tessera import config

#: Samples a second of the stand-in voice.
RATE = 16000
ORDER = ["data_acquisition", "audio_engineering", "sentence_generation", "tts_generation", "quality_control"]


def logger() -> logging.Logger:
    log = logging.getLogger("tessera")
    if not log.handlers:
        log.addHandler(logging.StreamHandler(sys.stdout))
        log.setLevel(logging.INFO)
    return log


def with_retries(work, tries: int = 3, backoff: float = 2.0):
    """Call work until it succeeds; the last failure is raised."""
    for attempt in range(1, max(1, tries) + 1):
        try:
            return work()
        except Exception:
            if attempt >= tries:
                raise
            time.sleep(backoff ** (attempt - 1))


def run(raw: dict, stages: list[str], log: logging.Logger) -> dict:
    """Stages in their fixed order over the folder that the settings name; later stages read what earlier ones wrote.

    Each stage leaves its summary as <stage>_summary.json, the run pipeline_summary.json and report.md.
    """
    from pyspark.sql import functions as F

    from tessera.functions import models
    from tessera.operators import reports
    from tessera.plans import stages as S
    from tessera.sources import manifests
    from tessera.session import session

    spark, out, seed, took = session(), raw["out_dir"].rstrip("/"), raw.get("seed", 1234), {}
    of = lambda name: config.stage(raw, name)
    table = lambda name: spark.read.parquet(f"{out}/{name}")
    models_of = lambda make, kind: models.plug(make, kind)
    report: list[str] = []
    for name in [s for s in ORDER if s in stages]:
        began = time.time()
        if name == "data_acquisition":
            s = of(name)
            pulled = with_retries(lambda s=s: S.acquire(spark, s, seed, out), s.max_retries, s.retry_backoff)
            S.with_files(pulled, out).write.mode("overwrite").parquet(f"{out}/reference")
            found = reports.status_counts(table("reference"))
        elif name == "audio_engineering":
            S.prepare(table("reference"), of(name)).write.mode("overwrite").parquet(f"{out}/prepared")
            found = reports.status_counts(table("prepared"))
        elif name == "sentence_generation":
            asked = S.propose(spark, of(name), models_of(models.stub_generator, "string"))
            pool, outcomes = S.sentence_pool(asked, of(name), models_of(models.stub_embedder, "array<float>"))
            pool.write.mode("overwrite").parquet(f"{out}/sentences")
            outcomes.write.mode("overwrite").parquet(f"{out}/outcomes")
            found = reports.status_counts(table("outcomes"), "outcome")
            report += ["## Sentences", reports.markdown(reports.reason_table(table("outcomes").filter("outcome <> 'accepted'").select(F.col("outcome").alias("reason"))))]
        elif name == "tts_generation":
            voice = models_of(models.stub_synthesizer, "array<float>")
            S.speak(spark, table("sentences"), table("prepared"), of(name), voice).write.mode("overwrite").parquet(f"{out}/utterances")
            S.utterance_files(table("utterances"), RATE, out).write.mode("overwrite").parquet(f"{out}/utterance_files")
            found = reports.status_counts(table("utterances"))
        else:
            heard = models_of(models.stub_transcriber, "string")
            voices = S.reference_samples(table("prepared"))
            rows = S.certify_new(spark, table("utterances"), f"{out}/dataset", of(name), RATE, heard, voices, models_of(models.stub_speaker, "array<double>"))
            rows = rows.withColumn("language", F.coalesce("language", F.lit("?")))
            found = reports.datacard(rows)
            words = rows.filter("qc_passed").withColumns({"chars": F.length("text"), "words": F.size(F.split("text", " "))})
            parts = [("Datacard", found), ("Languages", reports.per_language(rows, "utt_id")), ("Distributions", reports.summaries(words, ["duration", "chars", "words", "cer", "speaker_sim"]))]
            parts += [("Rejections", reports.rejections(rows)), ("Checks", reports.check_metrics(rows)), ("Speakers", reports.per_speaker(rows)), ("Gender", reports.gender_balance(rows, "utt_id"))]
            report += [line for title, rows in parts for line in (f"## {title}", reports.markdown(rows))]
            log.info("%s", reports.markdown(found))
        took[name] = round(time.time() - began, 2)
        done = manifests.summary(reports.one_document(found)) | {"elapsed_s": took[name]}
        manifests.write_document(spark, f"{out}/{name}_summary.json", json.dumps(done))
        log.info("%s: %.1f s, %s", name, took[name], done)
    manifests.write_document(spark, f"{out}/pipeline_summary.json", json.dumps(took))
    manifests.write_document(spark, f"{out}/report.md", "\n\n".join(["# Report", *report]) + "\n")
    return took


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    parser.add_argument("--stages", nargs="*", choices=ORDER, default=ORDER)
    parser.add_argument("--validate-only", action="store_true")
    parser.add_argument("--no-validate", action="store_true")
    args = parser.parse_args(argv)
    log, raw = logger(), config.load(args.config)
    if not args.no_validate:
        errors, warnings = config.faults(raw)
        for w in warnings:
            log.warning("%s", w)
        for e in errors:
            log.error("%s", e)
        if errors:
            return 2
    if not args.validate_only:
        log.info("%s", json.dumps(run(raw, args.stages, log)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
