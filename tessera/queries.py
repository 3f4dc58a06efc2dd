"""One query for each operator, with the SQL that must give the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import config, schema
from tessera.functions import models, signal, text
from tessera.functions.numbers import rounded
from tessera.operators import dedup, pairing, reports, resume, sampling, verdict
from tessera.plans import stages
from tessera.plans.fixtures import CANDIDATES, SIGNALS, SPEAKERS, SPOKEN, VOICE, candidates, signals, spoken, t, voice_bank
from tessera.sources import audio, catalog, manifests
from tessera.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# Scans, filters and sources


@query(f"WITH {VOICE} SELECT fname, lang, duration, coalesce(gender, 'unknown') AS gender, speaker_id, source_file, row_index FROM voice")
def catalog_scan(spark, sf):
    bank = voice_bank(spark, sf)
    return bank.select("fname", "lang", "duration", sampling.canonical_gender(F.col("gender")).alias("gender"), "speaker_id", "source_file", "row_index")


@query(f"WITH {VOICE} SELECT lang, speaker_id, row_index, duration FROM good")
def eligible_clips(spark, sf):
    return sampling.eligible(voice_bank(spark, sf)).select("lang", "speaker_id", "row_index", "duration")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND length(o_orderpriority) > 0")
def status_filter(spark, sf):
    return t(spark, sf, "orders").filter("o_orderstatus = 'F' AND length(o_orderpriority) > 0").select("o_orderkey", "o_orderstatus")


@query("""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '.html' WHEN page_id % 5 = 1 THEN '.wav' WHEN page_id % 5 = 2 THEN '.flac' WHEN page_id % 5 = 3 THEN '.ogg' ELSE '.bin' END AS ext FROM pages""")
def format_sniff(spark, sf):
    heads = F.array(*[F.lit(b) for b in (b"", b"RIFF0000WAVEfmt ", b"fLaC....", b"OggS....", b"....")])
    pages = t(spark, sf, "pages").select("page_id", F.get(heads, (F.col("page_id") % 5).cast("int")).alias("b"), F.when(F.col("page_id") % 5 == 0, "a/B.HTML").alias("p"))
    return pages.select("page_id", catalog.sniff(F.col("b"), F.col("p")).alias("ext"))


GROUPS = "WITH o AS (SELECT o_orderpriority AS source_file, o_orderkey AS k, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS row_index FROM orders)"


@query(f"WITH {SPEAKERS}, " + GROUPS.removeprefix("WITH ") + """ SELECT o.source_file, o.row_index // 100 AS row_group, count(*) AS rows_wanted
  FROM o JOIN sampled s ON s.source_file = o.source_file AND s.row_index = o.k GROUP BY ALL""")
def row_group_lookup(spark, sf):
    """The row groups, of 100 rows each, that the selected clips lie in."""
    order = Window.partitionBy("source_file").orderBy("k")
    rows = t(spark, sf, "orders").select(F.col("o_orderpriority").alias("source_file"), F.col("o_orderkey").alias("k"))
    rows = rows.withColumn("row_index", F.row_number().over(order) - 1)
    groups = rows.groupBy("source_file", F.floor(F.col("row_index") / 100).alias("row_group")).agg(F.count("*").alias("n_rows"), F.sum("k").alias("n_bytes"))
    wanted = rows.join(_selected(spark, sf).select("source_file", F.col("row_index").alias("k")), ["source_file", "k"], "left_semi")
    return catalog.row_groups_touched(wanted, groups).drop("n_bytes")


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS downloaded, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(DISTINCT (o_orderpriority, o_orderkey // 100)) AS row_groups, round(sum(o_totalprice), 2) AS bytes FROM orders")
def pull_stats(spark, sf):
    group = F.struct("o_orderpriority", F.floor(F.col("o_orderkey") / 100))
    return t(spark, sf, "orders").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("downloaded"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"),
        F.countDistinct(group).alias("row_groups"), rounded(F.sum("o_totalprice"), 2).alias("bytes"),
    )


def _folder(spark: SparkSession, label: str) -> str:
    """A new folder in the place that the session's executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


LANGS = [f"NATION_{i}" for i in range(25)]


def _bank_files(spark, sf) -> tuple[str, list[str]]:
    """The voice bank as files, one for each language, with the clip's name as its audio bytes; and the languages' folders."""
    folder = _folder(spark, "bank")
    rows = voice_bank(spark, sf).withColumn("audio_filepath", F.struct(F.col("fname").cast("binary").alias("bytes"), F.col("fname").alias("path")))
    rows = rows.select("lang", *catalog.META, "audio_filepath", F.col("row_index").alias("k"))
    rows.repartition("lang").sortWithinPartitions("lang", "k").write.partitionBy("lang").parquet(folder)
    return folder, [f"lang={x}" for x in LANGS]


FILES = VOICE + ", bank AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY row_index) - 1 AS place FROM voice)"


@query(f"WITH {FILES} SELECT lang, place AS row_index, fname, duration, coalesce(gender, 'unknown') AS gender, speaker_id FROM bank")
def catalog_files(spark, sf):
    """The catalogue of files, with each row's place in its file."""
    folder, languages = _bank_files(spark, sf)
    rows = catalog.scan(spark, "local", folder, languages, "part")
    return catalog.in_order(rows).select(F.substring_index("lang", "=", -1).alias("lang"), "row_index", "fname", "duration", "gender", "speaker_id")


@query(f"""WITH {FILES}, pick AS (SELECT * FROM bank WHERE duration BETWEEN 5.0 AND 9.0)
  SELECT lang, place AS row_index, '.wav' AS ext, length(fname)::BIGINT AS n_bytes, 'downloaded' AS status FROM pick UNION ALL SELECT lang, 1000000, '.bin', 0, 'failed' FROM (SELECT DISTINCT lang FROM bank)""")
def pulled_clips(spark, sf):
    """Bytes of chosen clips, read from their files by place, and a place of each file that doesn't exist."""
    folder, languages = _bank_files(spark, sf)
    rows = catalog.scan(spark, "local", folder, languages, "part").select("lang", "source_file", "row_index", "duration")
    wanted = rows.filter("duration BETWEEN 5.0 AND 9.0").drop("duration")
    absent = rows.select("lang", "source_file").distinct().withColumn("row_index", F.lit(1000000).cast("long"))
    pulled = catalog.pull_audio(spark, wanted.unionByName(absent).withColumn("status", F.lit("selected")))
    return pulled.select(F.substring_index("lang", "=", -1).alias("lang"), "row_index", "ext", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("n_bytes"), "status")


@query("SELECT o_orderkey AS k, o_orderpriority AS status FROM orders UNION ALL SELECT o_orderkey, 'again' FROM orders WHERE o_orderstatus = 'P'")
def manifest_round_trip(spark, sf):
    """A manifest written, added to and read back with its schema."""
    path, kind = _folder(spark, "manifest"), schema.of("k long, status string")
    rows = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("status"), "o_orderstatus")
    manifests.write(rows.drop("o_orderstatus"), path)
    manifests.append(rows.filter("o_orderstatus = 'P'").select("k", F.lit("again").alias("status")), path)
    return manifests.read(spark, path, kind, tolerant=True)


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props::JSON)) AS key FROM events) GROUP BY 1")
def document_keys(spark, sf):
    return reports.keys_found(t(spark, sf, "events"), "props")


@query("SELECT * FROM (VALUES ('seed: must be a whole number of at least 0', 'error'), ('data_acquisition.clips_per_speaker: 0 is below 1', 'error'), ('audio_engineering.norm: ''loud'' isn''t one of [''peak'', ''rms'']', 'error'), ('quality_control.typo: unknown', 'warning')) v(message, kind)")
def settings_faults(spark, sf):
    """Every fault of a settings document at once."""
    raw = {"seed": -1, "data_acquisition": {"clips_per_speaker": 0}, "audio_engineering": {"norm": "loud"}, "quality_control": {"typo": 1}}
    errors, warnings = config.faults(raw)
    return spark.createDataFrame([(m, "error") for m in errors] + [(m, "warning") for m in warnings], "message string, kind string")


# Selection


@query(f"WITH {SPEAKERS} SELECT * FROM spk")
def speaker_gender(spark, sf):
    return sampling.speaker_gender(sampling.eligible(voice_bank(spark, sf)))


@query(f"WITH {SPEAKERS} SELECT * FROM chosen")
def stratified_speakers(spark, sf):
    return sampling.stratified_speakers(sampling.speaker_gender(sampling.eligible(voice_bank(spark, sf))), 7, 1234)


def _selected(spark, sf):
    return sampling.select_clips(voice_bank(spark, sf), 7, 2, 1234)


@query(f"WITH {SPEAKERS} SELECT lang, speaker_id, gender, source_file, row_index FROM sampled")
def clip_sample(spark, sf):
    return _selected(spark, sf).select("lang", "speaker_id", "gender", "source_file", "row_index")


@query(f"""WITH {SPEAKERS} SELECT lang || '_spk' || speaker_id || '_' || left(sha256(source_file), 8) || '_' || row_index AS ref_id, lang, speaker_id, gender,
  'bank' AS source_repo, 'valid' AS source_split, source_file, row_index, fname, text AS ref_text, duration, NULL::VARCHAR AS local_audio_path, 'selected' AS status FROM sampled""")
def selection_manifest(spark, sf):
    return sampling.selection_manifest(_selected(spark, sf), "bank", "valid")


@query(f"""WITH {SPEAKERS}, a AS (SELECT lang, count(DISTINCT speaker_id) AS available FROM good GROUP BY 1)
  SELECT lang, count(*) AS clips, count(DISTINCT speaker_id) AS chosen, count(DISTINCT speaker_id) FILTER (WHERE gender = 'male') AS male,
  count(DISTINCT speaker_id) FILTER (WHERE gender = 'female') AS female, any_value(available) AS available FROM sampled JOIN a USING (lang) GROUP BY lang""")
def selection_summary(spark, sf):
    return sampling.selection_summary(_selected(spark, sf), sampling.eligible(voice_bank(spark, sf)))


@query("SELECT o_orderkey, ('0x' || left(sha256(concat_ws('|', '1234', o_orderpriority, o_orderkey)), 8))::BIGINT AS seed FROM orders")
def derived_seeds(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", text.seed(1234, F.col("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("seed"))


# Text gates


@query(f"WITH {CANDIDATES} SELECT seq FROM cand WHERE regexp_matches(text, '\\p{{Nd}}|[₹$€£¥%]')")
def number_gate(spark, sf):
    return candidates(spark, sf).filter(text.has_number(F.col("text"))).select("seq")


@query(r"""SELECT doc_id, round(CASE WHEN length(regexp_replace(text, '[^\p{L}]', '', 'g')) = 0 THEN 0.0 ELSE
  length(regexp_replace(regexp_replace(text, '[^\p{L}]', '', 'g'), '[^\x{41}-\x{24f}]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) END, 6) AS ratio FROM documents""")
def script_ratio(spark, sf):
    return t(spark, sf, "documents").select("doc_id", rounded(text.script_ratio(F.col("text"), "Latin"), 6).alias("ratio"))


@query(f"WITH {CANDIDATES} SELECT seq, fault AS reason FROM judged WHERE fault IN ('too_short', 'too_long', 'low_diversity', 'repeated_word', 'repeated_ngram')")
def degeneracy(spark, sf):
    rows = candidates(spark, sf).filter(F.length("text") >= 2)
    return rows.select("seq", text.degeneracy(F.col("text")).alias("reason")).filter("reason IS NOT NULL")


@query(f"WITH {CANDIDATES} SELECT seq, md5(key) AS key FROM judged")
def norm_key(spark, sf):
    return candidates(spark, sf).select("seq", F.md5(text.dedup_key(F.col("text"), compose=False)).alias("key"))


def _judged(spark, sf):
    rows = candidates(spark, sf)
    return rows.withColumns({"fault": text.sentence_fault(F.col("text"), "Latin"), "key": text.dedup_key(F.col("text"), compose=False)})


@query(f"WITH {CANDIDATES} SELECT seq, coalesce(fault, 'ok') AS verdict FROM judged")
def sentence_verdict(spark, sf):
    return _judged(spark, sf).select("seq", F.coalesce("fault", F.lit("ok")).alias("verdict"))


def verdict_report(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences by language and outcome, repeats among the good ones included."""
    key = F.when(F.col("fault").isNull(), F.col("key"))
    by = _judged(spark, sf).groupBy("language", "fault", key.alias("key")).agg(F.count("*").alias("n"))  # of a key the first is good, the others repeat it
    good = F.col("fault").isNull()
    outcomes = F.array(F.struct(F.coalesce("fault", F.lit("accepted")).alias("reason"), F.when(good, 1).otherwise(F.col("n")).alias("n")), F.struct(F.lit("exact_duplicate").alias("reason"), F.when(good, F.col("n") - 1).otherwise(0).alias("n")))
    return by.select("language", F.inline(outcomes)).filter("n > 0").groupBy("language", "reason").agg(F.sum("n").alias("n"))


@query(f"""WITH {CANDIDATES} SELECT language, coalesce(j.fault, CASE WHEN f.seq IS NULL THEN 'exact_duplicate' ELSE 'accepted' END) AS reason, count(*) AS n
  FROM judged j LEFT JOIN (SELECT seq FROM firsts) f USING (seq) GROUP BY ALL""")
def rejection_counts(spark, sf):
    return verdict_report(spark, sf)


@query(f"""WITH {CANDIDATES} SELECT count(*) AS seen, count(*) FILTER (WHERE fault IS NULL) AS valid,
  round(count(*) FILTER (WHERE fault IS NULL) / count(*), 4) AS yield FROM judged""")
def yield_summary(spark, sf):
    good = F.count_if(F.col("fault").isNull())
    return _judged(spark, sf).agg(F.count("*").alias("seen"), good.alias("valid"), dedup.share(good, F.count("*")).alias("yield"))


@query(f"""WITH {CANDIDATES}, r AS (SELECT coalesce(fault, 'ok') AS reason FROM judged), c AS (SELECT reason, count(*) AS n FROM r WHERE reason <> 'ok' GROUP BY 1)
  SELECT reason, n, round(100 * n / sum(n) OVER (), 2) AS pct FROM c""")
def rejection_table(spark, sf):
    return reports.reason_table(_judged(spark, sf).filter("fault IS NOT NULL").select(F.col("fault").alias("reason")))


@query(r"""WITH v AS (SELECT doc_id, list_transform(['de', 'en', 'es', 'fr'], lambda l: list_sum(list_transform(string_split(text, ' '), lambda w: CASE WHEN list_contains(CASE l
    WHEN 'de' THEN ['der', 'die', 'und', 'in', 'ein'] WHEN 'en' THEN ['the', 'of', 'and', 'to', 'is'] WHEN 'es' THEN ['el', 'que', 'y', 'los', 'un'] ELSE ['le', 'et', 'les', 'des', 'une'] END, w) THEN 1 ELSE 0 END))::BIGINT) AS h, lang FROM documents),
  b AS (SELECT doc_id, lang, ['de', 'en', 'es', 'fr'][list_position(h, list_max(h))] AS label, list_max(h) / greatest(1, list_sum(h)) AS confidence FROM v)
  SELECT doc_id, label, round(confidence, 6) AS confidence, CASE WHEN label <> lang OR confidence < 0.5 THEN 'langid_mismatch:' || label END AS fault FROM b""")
def language_gate(spark, sf):
    """The language gate over whole texts, with the stand-in's label and confidence."""
    listen = models.plug(models.stub_language, models.SAID)
    rows = t(spark, sf, "documents").select("doc_id", "lang", listen("text").alias("s"))
    fault = text.language_fault(F.col("s.value"), F.col("lang"), 0.5)
    return rows.select("doc_id", F.col("s.value.label").alias("label"), rounded("s.value.confidence", 6).alias("confidence"), fault.alias("fault"))


@query(f"WITH {CANDIDATES} SELECT seq, len(ws) AS word_count, length(text) AS char_count FROM judged WHERE fault IS NULL")
def sentence_records(spark, sf):
    rows = _judged(spark, sf).filter("fault IS NULL")
    return rows.select("seq", F.size(text.words(F.col("text"))).cast("long").alias("word_count"), F.length("text").cast("long").alias("char_count"))


@query("""SELECT language || '|' || source || '|' || attempt AS cell, 'Write 12 different statement sentences in ' || language || ' (Latin script) about ' || source || '. One sentence on each line, numbers in words, no list marks.' AS prompt,
  ('0x' || left(sha256(concat_ws('|', '1234', language, source, attempt)), 8))::BIGINT AS seed
  FROM (SELECT DISTINCT lang AS language FROM documents) CROSS JOIN (SELECT DISTINCT source FROM documents) CROSS JOIN (SELECT unnest(range(3))::VARCHAR AS attempt)""")
def prompts(spark, sf):
    """The prompt and the seed of every cell and attempt."""
    docs = t(spark, sf, "documents")
    cells = dedup.grid(docs.select(F.col("lang").alias("language")).distinct(), docs.select("source").distinct(), spark.range(3).select(F.col("id").cast("string").alias("attempt")))
    asked = text.prompt(F.col("language"), F.lit("Latin"), F.col("source"), F.lit("statement"), F.lit(12))
    seeded = text.seed(1234, F.col("language"), F.col("source"), F.col("attempt"))
    return cells.select(F.concat_ws("|", "language", "source", "attempt").alias("cell"), asked.alias("prompt"), seeded.alias("seed"))


LINES = r"""SELECT doc_id, len(l) AS n, array_to_string(list_transform(l, lambda x: x[1:12]), '|') AS heads FROM (SELECT doc_id, list_filter(list_transform(string_split('- 1. "' || text, chr(10)),
  lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(x), '^\s*[-*•]\s*', ''), '^\s*\d+[.)]\s*', ''), '^\s+|\s+$', '', 'g'), '^"+|"+$', '', 'g'), '^[“”]+|[“”]+$', '', 'g')), lambda x: trim(x) <> '') AS l FROM documents)"""


@query(LINES)
def parse_lines(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", text.parse_lines(F.concat(F.lit('- 1. "'), "text"), plain=True).alias("l"))
    return rows.select("doc_id", F.size("l").cast("long").alias("n"), F.array_join(F.transform("l", lambda x: F.substring(x, 1, 12)), "|").alias("heads"))


# Dedup, quotas, grid


@query(f"WITH {CANDIDATES} SELECT seq, language FROM firsts")
def exact_dedup(spark, sf):
    return dedup.first_of_each(_judged(spark, sf).filter("fault IS NULL").select("seq", "language", "key"), ["language", "key"], ["seq"]).select("seq", "language")


@query("""WITH e AS (SELECT vec_id, label % 2 AS block, embedding AS v FROM embeddings)
  SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, 65), lambda i: a.v[i]::DOUBLE * b.v[i]::DOUBLE)), 5) AS similarity FROM e a JOIN e b ON a.block = b.block AND a.vec_id < b.vec_id
  WHERE list_sum(list_transform(range(1, 65), lambda i: a.v[i]::DOUBLE * b.v[i]::DOUBLE)) >= 0.35""")
def near_dup_pairs(spark, sf):
    vectors = t(spark, sf, "embeddings").withColumn("block", F.col("label") % 2)
    return dedup.near_pairs(vectors, 0.35, "block").withColumn("similarity", rounded("similarity", 5))


@query(f"WITH {CANDIDATES} SELECT seq, language, source, kind FROM firsts QUALIFY row_number() OVER (PARTITION BY language, source, kind ORDER BY seq) <= 13")
def cell_quota(spark, sf):
    firsts = dedup.first_of_each(_judged(spark, sf).filter("fault IS NULL").select("seq", "language", "key", "source", "kind"), ["language", "key"], ["seq"])
    return dedup.within_quota(firsts, ["language", "source", "kind"], ["seq"], 13).select("seq", "language", "source", "kind")


@query(f"""WITH {CANDIDATES}, c AS (SELECT language, source, kind, count(*) AS n FROM firsts GROUP BY ALL)
  SELECT l.language, s.source, k.kind, coalesce(n, 0) AS n, greatest(13 - coalesce(n, 0), 0) AS missing FROM (SELECT DISTINCT lang AS language FROM documents) l
  CROSS JOIN (SELECT DISTINCT source FROM documents) s CROSS JOIN (VALUES ('statement'), ('question'), ('exclamation')) k(kind) LEFT JOIN c USING (language, source, kind)""")
def grid_coverage(spark, sf):
    docs = t(spark, sf, "documents")
    kinds = spark.createDataFrame([("statement",), ("question",), ("exclamation",)], "kind string")
    cells = dedup.grid(docs.select(F.col("lang").alias("language")).distinct(), docs.select("source").distinct(), kinds)
    counts = cells_filled(spark, sf)
    n = F.coalesce("n", F.lit(0))
    return cells.join(counts, ["language", "source", "kind"], "left").select("language", "source", "kind", n.alias("n"), F.greatest(13 - n, F.lit(0)).alias("missing"))


def cells_filled(spark, sf):
    firsts = dedup.first_of_each(_judged(spark, sf).filter("fault IS NULL").select("seq", "language", "key", "source", "kind"), ["language", "key"], ["seq"])
    return firsts.groupBy("language", "source", "kind").agg(F.count("*").alias("n"))


@query(f"WITH {CANDIDATES} SELECT seq, language || '_' || lpad((row_number() OVER (ORDER BY language, seq) - 1)::VARCHAR, 6, '0') AS id FROM firsts")
def pool_numbers(spark, sf):
    """Numbers of the pool's sentences, counted over all languages."""
    firsts = dedup.first_of_each(_judged(spark, sf).filter("fault IS NULL").select("seq", "language", "key"), ["language", "key"], ["seq"])
    return stages.numbered(firsts).select("seq", "id")


@query()
def greedy_accept(spark, sf):
    """Exact only in order; tested against a plain loop."""
    cell = F.concat_ws("|", "language", "source", "kind").alias("cell")
    embedded = models.plug(models.stub_embedder, "array<float>")
    rows = _judged(spark, sf).select("seq", "language", cell, "key", "fault", embedded(F.when(F.col("fault").isNull(), F.col("text"))).alias("v"))
    rows = rows.withColumn("vector", F.when(F.col("fault").isNull(), F.col("v.value"))).drop("v")
    return dedup.accept_in_order(rows, quota=13, threshold=0.92)


# Pairing


CODES = "codes(code, name) AS (VALUES ('n0', 'NATION_0'), ('n1', 'NATION_1'), ('n2', 'NATION_2'))"


def _references(spark, sf):
    codes = spark.createDataFrame([(f"n{i}", f"NATION_{i}") for i in range(3)], "code string, name string")
    rows = sampling.selection_manifest(_selected(spark, sf), "bank", "valid")
    return pairing.with_code(rows, codes)


@query(f"""WITH {SPEAKERS}, {CODES} SELECT coalesce(code, lang) AS code, lang, count(*) AS n FROM sampled LEFT JOIN codes ON lang = name GROUP BY ALL""")
def lang_map_join(spark, sf):
    return _references(spark, sf).groupBy("code", "lang").agg(F.count("*").alias("n"))


PAIRS = f"""WITH {SPEAKERS}, {CODES}, refs AS (
    SELECT coalesce(code, lang) AS language, lang || '_spk' || speaker_id || '_' || left(sha256(source_file), 8) || '_' || row_index AS ref_id, speaker_id, gender FROM sampled LEFT JOIN codes ON lang = name
  ), rj AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY ref_id) - 1 AS j, count(*) OVER (PARTITION BY language) AS n FROM refs
  ), sent AS (SELECT 's' || lpad(doc_id::VARCHAR, 6, '0') AS id, CASE lang WHEN 'de' THEN 'n0' WHEN 'fr' THEN 'n1' WHEN 'en' THEN 'NATION_3' ELSE 'none' END AS language, text FROM documents
  ), sk AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY id) - 1 AS k FROM sent
  ), pairs AS (SELECT s.id, s.language, s.text, r.ref_id, r.speaker_id, r.gender FROM sk s JOIN rj r ON s.language = r.language AND s.k % r.n = r.j) """


def _pairs(spark, sf):
    lang = F.expr("CASE lang WHEN 'de' THEN 'n0' WHEN 'fr' THEN 'n1' WHEN 'en' THEN 'NATION_3' ELSE 'none' END")
    sentences = t(spark, sf, "documents").select(F.concat(F.lit("s"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("id"), lang.alias("language"), "text")
    refs = _references(spark, sf).select(F.col("code").alias("language"), "ref_id", "speaker_id", "gender", F.col("local_audio_path").alias("ref_audio_path"))
    return pairing.round_robin(sentences, refs)


@query(PAIRS + "SELECT id, language, ref_id FROM pairs")
def round_robin_pairs(spark, sf):
    return _pairs(spark, sf).select("id", "language", "ref_id")


@query(PAIRS + "SELECT id AS utt_id, 'audio/' || id || '.wav' AS audio_filepath, text, speaker_id, gender, language, ref_id, '' AS ref_audio_path, 'synthesized' AS status FROM pairs")
def utterances(spark, sf):
    return pairing.utterances(_pairs(spark, sf))


CHUNKS = r"""WITH p AS (SELECT doc_id, regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS b FROM documents),
  s AS (SELECT doc_id, b, list_filter(string_split(regexp_replace(b, '([।!?.])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS parts FROM p),
  c AS (SELECT doc_id, CASE WHEN length(b) <= 300 THEN [b] ELSE list_reduce(parts, lambda acc, x:
    CASE WHEN length(acc[-1]) + 1 + length(x[1]) <= 300 THEN list_concat(acc[:-2], [acc[-1] || ' ' || x[1]]) ELSE list_concat(acc, x) END, []::VARCHAR[]) END AS chunks
    FROM (SELECT doc_id, b, list_transform(parts, lambda x: [x]) AS parts FROM s))
"""


@query(CHUNKS + "SELECT doc_id, len(chunks) AS n_chunks, list_max(list_transform(chunks, lambda x: length(x))) AS longest, md5(array_to_string(chunks, chr(1))) AS chunks FROM c")
def chunk_text(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", text.chunk(F.col("text")).alias("c"))
    return rows.select("doc_id", F.size("c").cast("long").alias("n_chunks"), F.array_max(F.transform("c", F.length)).cast("long").alias("longest"), F.md5(F.array_join("c", "\x01")).alias("chunks"))


# Fidelity


def _scored(spark, sf):
    score = lambda c: text.score_text(F.col(c), compose=False)
    rows = spoken(spark, sf).withColumn("cer", text.character_error_rate(score("text"), score("asr_transcript")))
    return rows.withColumn("spc", text.seconds_per_char(F.col("duration"), F.col("text")))


@query(f"WITH {SPOKEN} SELECT utt_id, round(cer, 6) AS cer FROM cers")
def cer(spark, sf):
    return _scored(spark, sf).select("utt_id", rounded("cer", 6).alias("cer"))


@query(f"WITH {SPOKEN} SELECT language, count(*) AS n, count(*) FILTER (WHERE cer <= 0.8) AS passed FROM cers GROUP BY 1")
def cer_gate(spark, sf):
    return _scored(spark, sf).groupBy("language").agg(F.count("*").alias("n"), F.count_if(F.col("cer") <= 0.8).alias("passed"))


def _runs(size: int) -> str:
    return f"""list_reduce(list_concat([{{'last': '', 'run': 0, 'best': 1}}], list_transform(range(0, len(ws) // {size}), lambda i: {{'last': array_to_string(ws[{size} * i + 1:{size} * i + {size}], ' '), 'run': 1, 'best': 1}})),
      lambda a, b: {{'last': b.last, 'run': CASE WHEN a.last = b.last THEN a.run + 1 ELSE 1 END, 'best': greatest(a.best, CASE WHEN a.last = b.last THEN a.run + 1 ELSE 1 END)}}).best"""


@query(rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\s\p{{Z}}]+'), lambda x: x <> '') AS ws FROM documents)
  SELECT doc_id, CASE WHEN len(ws) < 3 THEN 1 ELSE greatest({_runs(1)}, {_runs(2)}, {_runs(3)}) END AS repeats FROM w""")
def text_repetition(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.consecutive_repeats(F.col("text")).alias("repeats"))


@query(f"WITH {SPOKEN} SELECT utt_id, round(spc, 4) AS metric, coalesce(spc BETWEEN 0.04 AND 0.30, false) AS passed FROM cers")
def dur_per_char(spark, sf):
    rows = _scored(spark, sf)
    return rows.select("utt_id", rounded("spc", 4).alias("metric"), F.coalesce(F.col("spc").between(0.04, 0.30), F.lit(False)).alias("passed"))


@query("""WITH x AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS c FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
  d AS (SELECT vec_id, sum(embedding[i]::DOUBLE * c) / (sqrt(sum(embedding[i]::DOUBLE * embedding[i]::DOUBLE)) * sqrt(sum(c * c)) + 1e-9) AS cos FROM embeddings JOIN x USING (label) GROUP BY vec_id)
  SELECT vec_id, round(cos, 5) AS cos, cos >= 0.3 AS passed FROM d""")
def cosine_gate(spark, sf):
    """Vectors against the centre of their label; a centre is 64 averages, so labels times 64 rows are broadcast."""
    rows = t(spark, sf, "embeddings")
    centres = rows.groupBy("label").agg(F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(64)]).alias("centre"))
    found = rows.join(centres, "label").select("vec_id", signal.cosine(F.col("embedding"), F.col("centre")).alias("c"))
    return found.select("vec_id", rounded("c", 5).alias("cos"), (F.col("c") >= 0.3).alias("passed"))


# Signals: 8-sample frames, 3 apart


@query(f"WITH {SIGNALS} SELECT user_id, i, round(levels[i + 1], 6) AS rms FROM (SELECT *, unnest(range(len(levels))) AS i FROM lev)")
def frame_rms(spark, sf):
    rows = signals(spark, sf).select("user_id", F.posexplode(signal.frame_rms(F.col("x"), 8, 3)).alias("i", "rms"))
    return rows.select("user_id", F.col("i").cast("long").alias("i"), rounded("rms", 6).alias("rms"))


@query(f"""WITH {SIGNALS} SELECT user_id, round(20 * log10(greatest(rms, 1e-12)), 2) AS dbfs,
  round(len(list_filter(levels, lambda v: v > greatest(list_max(levels) * 0.1, 10 ** (-45 / 20)))) / len(levels), 4) AS active FROM lev""")
def silence(spark, sf):
    rows = signals(spark, sf).withColumn("levels", signal.frame_rms(F.col("x"), 8, 3))
    return rows.select("user_id", rounded(signal.clamped_dbfs(signal.rms(F.col("x"))), 2).alias("dbfs"), rounded(signal.active_share(F.col("levels")), 4).alias("active"))


@query(f"""WITH {SIGNALS} SELECT user_id, round(len(list_filter(x, lambda v: v >= 0.3)) / len(x), 6) AS clipped,
  list_max(list_transform(string_split(array_to_string(list_transform(x, lambda v: CASE WHEN v >= 0.3 THEN '1' ELSE '0' END), ''), '0'), lambda s: length(s))) AS longest FROM sig""")
def clipping_runs(spark, sf):
    x = F.col("x")
    return signals(spark, sf).select("user_id", rounded(signal.clipped_share(x, 0.3), 6).alias("clipped"), signal.longest_run(x, 0.3).cast("long").alias("longest"))


@query(f"""WITH {SIGNALS} SELECT user_id, round(CASE WHEN len(levels) >= 3 THEN list_avg(levels[-6:]) / (list_aggregate(levels, 'quantile_cont', 0.95) + 1e-12) END, 4) AS ratio FROM lev""")
def truncation(spark, sf):
    rows = signals(spark, sf).withColumn("levels", signal.frame_rms(F.col("x"), 8, 3))
    return rows.select("user_id", rounded(signal.tail_ratio(F.col("levels")), 4).alias("ratio"))


@query(f"""WITH {SIGNALS}, c AS (SELECT user_id, list_transform(x, lambda v: v - list_sum(x) / len(x)) AS y FROM sig), p AS (SELECT *, list_max(list_transform(y, lambda v: abs(v))) AS pk FROM c)
  SELECT user_id, round(pk, 6) AS peak_in, round(CASE WHEN pk <= 0 THEN 1.0 ELSE 10 ** (-1 / 20) / pk END, 5) AS gain, round(y[1] * CASE WHEN pk <= 0 THEN 1.0 ELSE 10 ** (-1 / 20) / pk END, 5) AS first_sample FROM p""")
def dc_peak_normalise(spark, sf):
    rows = signals(spark, sf).select("user_id", signal.without_offset(F.col("x")).alias("y"))
    rows = rows.withColumn("g", signal.gain(F.col("y"), "peak", -1.0))
    return rows.select("user_id", rounded(signal.peak(F.col("y")), 6).alias("peak_in"), rounded("g", 5).alias("gain"), rounded(F.get(signal.scaled(F.col("y"), F.col("g")), F.lit(0)), 5).alias("first_sample"))


@query(f"""WITH {SIGNALS}, e AS (SELECT user_id, x, list_transform(frames, lambda f: sqrt(list_sum(list_transform(f, lambda v: v * v)) / len(f))) AS l FROM fr),
  k AS (SELECT *, list_filter(range(len(l)), lambda i: l[i + 1] >= list_max(l) * 10 ** (-6 / 20)) AS loud FROM e)
  SELECT user_id, CASE WHEN len(x) < 8 OR list_max(l) <= 0 THEN 0 ELSE list_min(loud) * 3 END AS first, CASE WHEN len(x) < 8 OR list_max(l) <= 0 THEN len(x) ELSE least(len(x), list_max(loud) * 3 + 8) END AS last FROM k""")
def trim_bounds(spark, sf):
    rows = signals(spark, sf).select("user_id", signal.loud_span(F.col("x"), 8, 3, 6.0).alias("s"))
    return rows.select("user_id", F.col("s.first").cast("long").alias("first"), F.col("s.last").cast("long").alias("last"))


@query(f"""WITH {SIGNALS} SELECT user_id, array_to_string(list_filter([CASE WHEN list_max(x) >= 0.999 THEN 'input_clipped' END, CASE WHEN user_id % 3 = 0 THEN 'resampled_up' WHEN user_id % 3 = 1 THEN 'resampled_down' END,
  CASE WHEN len(x) / 4 > 15 THEN 'truncated_to_max' END, CASE WHEN rms <= 0 OR 20 * log10(rms) < -50 THEN 'near_silence' END], lambda f: f IS NOT NULL), ',') AS flags FROM lev""")
def clip_flags(spark, sf):
    x = F.col("x")
    rate = F.expr("CASE user_id % 3 WHEN 0 THEN 16000 WHEN 1 THEN 48000 ELSE 24000 END")
    flags = signal.clip_flags(signal.peak(x), rate, 24000, F.size(x) / 4, 15.0, signal.dbfs(signal.rms(x)))
    return signals(spark, sf).select("user_id", F.array_join(flags, ",").alias("flags"))


@query(f"""WITH {SIGNALS}, l AS (SELECT user_id, levels, unnest(range(3, 9)) AS lag FROM lev)
  SELECT user_id, lag, round(len(list_filter(range(1, len(levels) - lag + 1), lambda i: abs(levels[i] - levels[(i + lag)::INT]) <= 0.02)) / greatest(len(levels) - lag, 1), 4) AS same FROM l""")
def lag_self_similarity(spark, sf):
    """Share of frame pairs a lag apart with near-equal level, for each lag."""
    rows = signals(spark, sf).select("user_id", signal.frame_rms(F.col("x"), 8, 3).alias("l"))
    rows = rows.select("user_id", "l", F.explode(F.sequence(F.lit(3), F.lit(8))).alias("lag"))
    n = F.greatest(F.size("l") - F.col("lag"), F.lit(0))
    pairs = F.filter(F.sequence(F.lit(0), F.size("l") - 1), lambda i: F.coalesce(F.abs(F.get("l", i) - F.get("l", i + F.col("lag"))) <= 0.02, F.lit(False)))
    return rows.select("user_id", F.col("lag").cast("long").alias("lag"), rounded(F.size(pairs) / F.greatest(n, F.lit(1)), 4).alias("same"))


@query(f"WITH {SIGNALS} SELECT user_id, round(list_sum(list_transform(x, lambda v: (v + v / 2) / 2)) / len(x), 6) AS mean_level, round(list_max(x) / 32768, 9) AS first_scaled FROM sig")
def downmix(spark, sf):
    """Two channels mixed to one, and levels of 16-bit samples."""
    rows = signals(spark, sf).select("user_id", "x", signal.to_mono(F.transform("x", lambda v: F.array(v, v / 2))).alias("m"))
    return rows.select("user_id", rounded(signal.mean(F.col("m")), 6).alias("mean_level"), rounded(F.array_max(signal.from_int16(F.col("x"))), 9).alias("first_scaled"))


@query(f"WITH {SIGNALS} SELECT user_id, round(CASE WHEN rms <= 0 THEN 1.0 ELSE least(10 ** (-20 / 20) / rms, 10 ** (-1 / 20) / list_max(list_transform(x, lambda v: abs(v)))) END, 5) AS gain, true AS ok FROM lev")
def rms_gain(spark, sf):
    """Gain to a level, held below the ceiling, and the written signal's post-conditions."""
    x = F.col("x")
    rows = signals(spark, sf).withColumn("g", signal.gain(x, "rms", -20.0, -1.0))
    return rows.select("user_id", rounded("g", 5).alias("gain"), signal.sound_ok(signal.scaled(x, F.col("g"))).alias("ok"))


@query(f"WITH {SIGNALS} SELECT user_id, len(x) AS n_samples, 16000 AS rate, 1 AS channels, true AS same FROM sig")
def wav_round_trip(spark, sf):
    """Signals written as 16-bit WAV and decoded again, each sample within a step of what it was."""
    rows = signals(spark, sf).select("user_id", "x", F.col("x").alias("y"), F.lit(16000).alias("own"))
    back = audio.with_wav(rows, "y", "own", 16000, "w").select("user_id", "x", audio.decoded("w").alias("d"))
    near = F.forall(F.zip_with("x", signal.to_mono(F.col("d.samples")), lambda a, b: F.abs(a - b) < 1e-4), lambda v: v)
    return back.select("user_id", F.size("d.samples").cast("long").alias("n_samples"), F.col("d.rate").alias("rate"), F.col("d.channels").alias("channels"), near.alias("same"))


# Verdicts and reports


def _verdicts(spark, sf):
    rows = _scored(spark, sf)
    spc_ok = F.coalesce(F.col("spc").between(0.04, 0.30), F.lit(False))
    return verdict.with_verdict(
        rows, verdict.check("dur_per_char", spc_ok, rounded("spc", 4), F.format_string("%.3f s/char", "spc")), verdict.check("cer", F.col("cer") <= 0.8, F.col("cer"))
    )


@query(f"WITH {SPOKEN} SELECT utt_id, qc_passed, 2 - spc_ok::INT - cer_ok::INT AS n_failed FROM done")
def qc_verdict(spark, sf):
    return _verdicts(spark, sf).select("utt_id", "qc_passed", F.size("qc_reasons").alias("n_failed"))


@query(f"WITH {SPOKEN} SELECT utt_id, qc_passed, spc_ok AS dur_per_char_pass, round(round(spc, 4), 4) AS dur_per_char_metric, cer_ok AS cer_pass, round(cer, 4) AS cer_metric FROM done")
def check_flatten(spark, sf):
    return verdict.flattened(_verdicts(spark, sf), "utt_id", ["dur_per_char", "cer"]).drop("reasons")


@query(f"WITH {SPOKEN} SELECT utt_id, round(cer, 6) AS cer, NULL::DOUBLE AS absent FROM done")
def check_metric(spark, sf):
    """The metric of a named check, and of one that wasn't made."""
    return _verdicts(spark, sf).select("utt_id", rounded(verdict.metric("cer"), 6).alias("cer"), verdict.metric("speaker_cos").alias("absent"))


@query("""WITH r AS (SELECT label, arg_min(embedding, vec_id) AS ref FROM embeddings WHERE label <> 3 GROUP BY 1)
  SELECT vec_id, round(CASE WHEN ref IS NOT NULL THEN list_sum(list_transform(range(1, 65), lambda i: e.embedding[i]::DOUBLE * ref[i]::DOUBLE)) / (sqrt(list_sum(list_transform(range(1, 65), lambda i: e.embedding[i]::DOUBLE * e.embedding[i]::DOUBLE)))
    * sqrt(list_sum(list_transform(range(1, 65), lambda i: ref[i]::DOUBLE * ref[i]::DOUBLE))) + 1e-9) END, 5) AS speaker_sim FROM embeddings e LEFT JOIN r USING (label)""")
def speaker_similarity(spark, sf):
    """Vectors against their reference's, the first of their label; one label has no reference."""
    rows = t(spark, sf, "embeddings").select("vec_id", F.col("label").alias("ref_id"), F.col("embedding").alias("samples"))
    refs = rows.filter("ref_id <> 3").groupBy("ref_id").agg(F.min_by("samples", "vec_id").alias("samples"))
    same = lambda c: F.struct(F.col(c).alias("value"))  # noqa: E731  the vectors are the voices
    return stages.voice_similarity(rows, refs, same).select("vec_id", rounded("speaker_sim", 5).alias("speaker_sim"))


@query(f"WITH {SPOKEN} SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN NOT spc_ok THEN 'dur_per_char' END, CASE WHEN NOT cer_ok THEN 'cer' END], lambda r: r IS NOT NULL)) AS reason FROM done) GROUP BY 1")
def failure_reasons(spark, sf):
    rows = _verdicts(spark, sf).select(F.explode("qc_reasons").alias("r"))
    return rows.groupBy(verdict.reason_name(F.col("r")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {SPOKEN} SELECT count(*) AS checked, count(*) FILTER (WHERE qc_passed) AS passed, round(count(*) FILTER (WHERE qc_passed) / count(*), 4) AS pass_rate, count(DISTINCT language) AS languages,
  count(DISTINCT (language, speaker_id)) AS speakers, round(sum(duration) FILTER (WHERE qc_passed), 2) AS valid_seconds, round(sum(duration) FILTER (WHERE qc_passed) / 3600, 4) AS valid_hours FROM done""")
def datacard(spark, sf):
    return reports.datacard(_verdicts(spark, sf))


@query(f"""WITH {SPOKEN}, s AS (SELECT language, speaker_id, count(*) FILTER (WHERE qc_passed) AS valid, count(*) AS total, arg_min(gender, utt_id) AS gender FROM done GROUP BY ALL)
  SELECT language, sum(valid)::BIGINT AS valid, sum(total)::BIGINT AS total, count(*) AS speakers, count(*) FILTER (WHERE gender = 'male') AS male_speakers, count(*) FILTER (WHERE gender = 'female') AS female_speakers FROM s GROUP BY 1""")
def per_language(spark, sf):
    return reports.per_language(_verdicts(spark, sf), "utt_id")


@query(f"""WITH {SPOKEN}, s AS (SELECT language, speaker_id, gender, count(*) AS total, count(*) FILTER (WHERE qc_passed) AS v FROM done GROUP BY ALL)
  SELECT language, speaker_id, gender, total, (sum(v) OVER (PARTITION BY language, speaker_id))::BIGINT AS valid FROM s""")
def per_speaker(spark, sf):
    return reports.per_speaker(_verdicts(spark, sf))


@query(f"""WITH {SPOKEN}, s AS (SELECT language, speaker_id, arg_min(gender, utt_id) AS gender FROM done GROUP BY ALL), g AS (SELECT gender, count(*) AS speakers FROM s GROUP BY 1)
  SELECT gender, count(*) AS utterances, coalesce(any_value(speakers), 0) AS speakers FROM done LEFT JOIN g USING (gender) GROUP BY gender""")
def gender_balance(spark, sf):
    return reports.gender_balance(_verdicts(spark, sf), "utt_id")


WORDS_OF = r"len(list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> ''))"


def _dist(metric: str, value: str) -> str:
    return f"SELECT '{metric}' AS metric, round(min({value})::DOUBLE, 4) AS min_value, round(avg({value}), 4) AS avg_value, round(max({value})::DOUBLE, 4) AS max_value FROM done WHERE qc_passed HAVING count({value}) > 0"


@query(f"WITH {SPOKEN} " + " UNION ALL ".join(_dist(*x) for x in (("duration", "duration"), ("chars", "length(text)"), ("words", WORDS_OF), ("cer", "cer"))))
def distributions(spark, sf):
    rows = _verdicts(spark, sf).filter("qc_passed").withColumns({"chars": F.length("text"), "words": F.size(text.words(F.col("text")))})
    return reports.summaries(rows, ["duration", "chars", "words", "cer"])


@query(f"""WITH {SPOKEN}, f AS (SELECT unnest(list_filter([CASE WHEN NOT spc_ok THEN 'dur_per_char' END, CASE WHEN NOT cer_ok THEN 'cer' END], lambda r: r IS NOT NULL)) AS failed_check FROM done WHERE NOT qc_passed)
  SELECT failed_check, count(*) AS utterances, round(100 * count(*) / (SELECT count(*) FROM done WHERE NOT qc_passed), 2) AS pct FROM f GROUP BY 1""")
def qc_breakdown(spark, sf):
    return reports.rejections(_verdicts(spark, sf))


@query(f"""WITH {SPOKEN}, c AS (SELECT 'dur_per_char' AS check_name, round(spc, 4) AS m, spc_ok AS ok FROM done UNION ALL SELECT 'cer', cer, cer_ok FROM done)
  SELECT check_name, round(min(m), 4) AS min_value, round(avg(m), 4) AS avg_value, round(max(m), 4) AS max_value, count(*) FILTER (WHERE NOT ok) AS n_failed FROM c GROUP BY 1""")
def check_metrics(spark, sf):
    return reports.check_metrics(_verdicts(spark, sf))


@query(f"""WITH {CANDIDATES}, {SPOKEN.replace("done AS", "vd AS")}, s AS (
  SELECT 0 AS stage_no, 'clips' AS stage, count(*) AS seen, count(*) FILTER (WHERE o_orderstatus = 'F') AS passed FROM orders UNION ALL
  SELECT 1, 'prepared', count(*), count(*) FILTER (WHERE l_returnflag <> 'R') FROM lineitem UNION ALL
  SELECT 2, 'sentences', count(*), count(*) FILTER (WHERE fault IS NULL) FROM judged UNION ALL
  SELECT 3, 'utterances', count(*), count(*) FILTER (WHERE event_type <> 'error') FROM events UNION ALL SELECT 4, 'certified', count(*), count(*) FILTER (WHERE qc_passed) FROM vd)
  SELECT stage_no, stage, passed, seen - passed AS failed, round(passed / seen, 4) AS pass_rate FROM s""")
def stage_rates(spark, sf):
    return reports.stage_rates({
        "clips": (t(spark, sf, "orders"), F.col("o_orderstatus") == "F"), "prepared": (t(spark, sf, "lineitem"), F.col("l_returnflag") != "R"),
        "sentences": (_judged(spark, sf), F.col("fault").isNull()), "utterances": (t(spark, sf, "events"), F.col("event_type") != "error"), "certified": (_verdicts(spark, sf), F.col("qc_passed")),
    })


@query("""WITH s AS (SELECT event_type AS stage, sum(value) AS e, sum(CASE WHEN event_id % 10 = 0 THEN value ELSE 0 END) AS l, count(*) AS items FROM events GROUP BY ROLLUP (event_type))
  SELECT coalesce(stage, 'total') AS stage, round(e, 2) AS elapsed_s, round(e - l, 2) AS process_s, round(e / 3600, 4) AS hours, items::BIGINT AS items, round(items / (greatest(e, 1e-9) / 60), 3) AS items_per_min, round(l / e, 4) AS load_share FROM s""")
def throughput(spark, sf):
    load = F.when(F.col("event_id") % 10 == 0, F.col("value")).otherwise(0.0)
    stages = t(spark, sf, "events").groupBy(F.col("event_type").alias("stage")).agg(F.sum("value").alias("elapsed_s"), F.sum(load).alias("load_s"), F.count("*").alias("items"))
    return reports.throughput(stages)


@query("""SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL""")
def value_counts(spark, sf):
    return reports.value_counts(t(spark, sf, "orders"), ["o_orderstatus", "absent_field", "o_orderpriority"])


@query(f"""WITH {SIGNALS}, f AS (SELECT unnest([CASE WHEN list_max(x) >= 0.999 THEN 'input_clipped' END, CASE WHEN len(x) / 4 > 15 THEN 'truncated_to_max' END]) AS flag FROM sig)
  SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY 1""")
def flag_histogram(spark, sf):
    x = F.col("x")
    flags = signal.clip_flags(signal.peak(x), F.lit(24000), 24000, F.size(x) / 4, 15.0, F.lit(0.0))
    return signals(spark, sf).select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("SELECT 'absent' AS kind, unnest(['duration', 'topic']) AS field UNION ALL SELECT 'extra', unnest(['o_custkey', 'o_totalprice', 'o_orderdate', 'o_orderpriority', 'o_orderkey'])")
def schema_report(spark, sf):
    absent, extra = reports.fields_report(t(spark, sf, "orders"), ["duration", "topic", "o_orderstatus"])
    return spark.createDataFrame([("absent", f) for f in absent] + [("extra", f) for f in extra], "kind string, field string")


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_totalprice >= 5000 THEN 'price' END, CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'status' END,
  CASE WHEN NOT o_orderkey % 5 < 4 THEN 'key' END], lambda r: r IS NOT NULL), ',') AS broken FROM orders""")
def rule_violations(spark, sf):
    rules = {"price": F.col("o_totalprice") >= 5000, "status": F.col("o_orderstatus").isin("F", "O"), "key": F.col("o_orderkey") % 5 < 4}
    return t(spark, sf, "orders").select("o_orderkey", F.array_join(verdict.violations(rules), ",").alias("broken"))


# Resume and streaming


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25)")
def resume_antijoin(spark, sf):
    lines = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("status"), "l_quantity")
    return resume.pending(t(spark, sf, "orders").select("o_orderkey"), resume.done_keys(lines, "o_orderkey", "R", F.col("l_quantity") > 25), "o_orderkey")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_status(spark, sf):
    return resume.latest_status(t(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT time_bucket(INTERVAL '5 minutes', ts::TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, sf):
    counts = ingest.windowed_counts(t(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type"))
    return counts.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT doc_id, quality FROM labels QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality) = 1")
def stream_ingest(spark, sf):
    """Labels as JSON lines taken in by a stream, twice; the second run finds nothing new."""
    folder = _folder(spark, "ingest")
    kind = schema.of("doc_id long, quality int")
    t(spark, sf, "labels").select("doc_id", "quality").write.json(f"{folder}/in")
    for _ in range(2):
        ingest.ingest(spark, f"{folder}/in", kind, "doc_id", f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.schema(kind).parquet(f"{folder}/out")


@query("SELECT CASE WHEN quality = 0 THEN 'poor' ELSE 'toxic' END AS reason, count(*) AS \"count\" FROM labels WHERE quality = 0 OR toxic = 1 GROUP BY 1")
def stream_rejections(spark, sf):
    """Running counts by reason, over labels taken in as a stream."""
    folder, name = _folder(spark, "rejections"), f"rejections_{uuid.uuid4().hex}"
    reason = F.expr("CASE WHEN quality = 0 THEN 'poor' WHEN toxic = 1 THEN 'toxic' END")
    manifests.write(t(spark, sf, "labels").select("doc_id", reason.alias("reason")), f"{folder}/in")
    ingest.rejection_counts(spark, f"{folder}/in", schema.of("doc_id long, reason string"), name, f"{folder}/state").awaitTermination()
    return spark.table(name)


# Model plug points


@query(CHUNKS + """ SELECT doc_id, md5(regexp_replace(text, '[.!?]+$', '')) AS transcript, sum(length(c) * 6)::BIGINT AS n_samples,
  count(*) FILTER (WHERE length(c) = 0) AS errors, 64 AS n_dims FROM (SELECT doc_id, text, unnest(chunks) AS c FROM c JOIN documents USING (doc_id)) GROUP BY doc_id, text""")
def model_plugs(spark, sf):
    """The stand-ins over whole texts: heard and embedded at once, spoken chunk by chunk at 100 samples a second."""
    heard, vector = models.plug(models.stub_transcriber, "string"), models.plug(models.stub_embedder, "array<float>")
    voice = models.plug(partial(models.stub_synthesizer, 100), "array<float>")
    rows = t(spark, sf, "documents").select("doc_id", "text")
    spoken = rows.select("doc_id", F.explode(text.chunk(F.col("text"))).alias("c")).select("doc_id", voice("c").alias("v"))
    said = spoken.groupBy("doc_id").agg(F.sum(F.coalesce(F.size("v.value"), F.lit(0))).alias("n_samples"), F.count("v.error").alias("errors"))
    out = rows.select("doc_id", heard("text").alias("h"), vector("text").alias("e")).join(said, "doc_id")
    return out.select("doc_id", F.md5("h.value").alias("transcript"), "n_samples", "errors", F.size("e.value").alias("n_dims"))


@query("SELECT lang, CASE lang WHEN 'de' THEN 'de' WHEN 'en' THEN 'en' ELSE 'fr' END AS code, count(*) AS n FROM documents GROUP BY ALL")
def language_names(spark, sf):
    """A fixed map joined to its names, unmapped names standing for themselves."""
    names = spark.createDataFrame([("de", "de"), ("en", "en"), ("fr", "fr"), ("fr", "es")], "code string, name string")
    return pairing.with_code(t(spark, sf, "documents").select("lang"), names).groupBy("lang", "code").agg(F.count("*").alias("n"))


