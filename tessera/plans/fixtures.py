"""The pipeline's roles as played by the benchmark tables, in DataFrames and in SQL for the oracle."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sampling import canonical_gender


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def voice_bank(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as clips, customers as speakers, nations as languages, priorities as files."""
    orders, customer, nation = (t(spark, sf, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    raw = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE element_at(map('AUTOMOBILE', ' M ', 'BUILDING', 'female', 'FURNITURE', 'F', 'HOUSEHOLD', ''), c_mktsegment) END")
    raw = F.when((F.col("o_orderkey") % 7 != 0) & (F.col("c_mktsegment") == "MACHINERY"), "Other").otherwise(raw)
    return joined.select(
        F.col("n_name").alias("lang"), F.col("c_custkey").alias("speaker_id"), F.when(raw.isNotNull(), canonical_gender(raw)).alias("gender"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0), "  ").otherwise(F.concat(F.lit("clip "), F.col("o_orderkey").cast("string"))).alias("text"),
        (F.col("o_totalprice") / 25000).alias("duration"), F.col("o_orderpriority").alias("source_file"), F.col("o_orderkey").alias("row_index"),
        F.concat(F.lit("clip_"), F.col("o_orderkey").cast("string"), F.lit(".wav")).alias("fname"),
    )


VOICE = """voice AS (
  SELECT n_name AS lang, c_custkey AS speaker_id,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'male' WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'female'
      WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE 'other' END AS gender,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN '  ' ELSE 'clip ' || o_orderkey END AS text,
    o_totalprice / 25000 AS duration, o_orderpriority AS source_file, o_orderkey AS row_index, 'clip_' || o_orderkey || '.wav' AS fname
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), good AS (SELECT * FROM voice WHERE duration BETWEEN 3.0 AND 15.0 AND length(trim(text)) > 0)"""
SPEAKERS = VOICE + """, spk AS (
  SELECT lang, speaker_id, arg_min(gender, (source_file, row_index)) AS gender FROM good WHERE gender IS NOT NULL GROUP BY ALL
), keyed AS (SELECT *, sha256(concat_ws(':', '1234', lang, speaker_id)) AS k FROM spk
), r1 AS (SELECT *, row_number() OVER (PARTITION BY lang, gender ORDER BY k, speaker_id)
    <= CASE gender WHEN 'male' THEN 4 WHEN 'female' THEN 3 ELSE 0 END AS in_quota FROM keyed
), chosen AS (SELECT lang, speaker_id, gender FROM r1 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY in_quota DESC, k, speaker_id) <= 7
), sampled AS (
  SELECT g.* EXCLUDE (gender), c.gender FROM good g JOIN chosen c USING (lang, speaker_id)
  QUALIFY row_number() OVER (PARTITION BY lang, speaker_id ORDER BY sha256(concat_ws(':', '1234', lang, speaker_id, source_file, row_index)), source_file, row_index) <= 2
)"""


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of the documents, in order; a cell is language, source and kind of sentence."""
    docs = t(spark, sf, "documents").select("doc_id", "lang", "source", F.posexplode(F.split("text", r"(?<=[.!?\n])\s+")).alias("pos", "text"))
    kind = F.when(F.col("text").endswith("?"), "question").when(F.col("text").endswith("!"), "exclamation").otherwise("statement")
    return docs.select((F.col("doc_id") * 100000 + F.col("pos")).alias("seq"), F.col("lang").alias("language"), "source", kind.alias("kind"), "text")


CANDIDATES = r"""raw AS (
  SELECT doc_id, lang, source, string_split(regexp_replace(text, '([.!?\n])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents
), cand AS (
  SELECT doc_id * 100000 + i AS seq, lang AS language, source, parts[i + 1] AS text,
    CASE WHEN suffix(parts[i + 1], '?') THEN 'question' WHEN suffix(parts[i + 1], '!') THEN 'exclamation' ELSE 'statement' END AS kind
  FROM (SELECT *, unnest(range(len(parts))) AS i FROM raw)
), w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> '') AS ws FROM cand
), judged AS (
  SELECT *, CASE WHEN length(text) < 2 THEN 'empty'
    WHEN len(ws) < 5 THEN 'too_short' WHEN len(ws) > 20 THEN 'too_long'
    WHEN len(list_distinct(ws)) / len(ws) < 0.55 THEN 'low_diversity'
    WHEN len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) > 0 THEN 'repeated_word'
    WHEN len(ws) >= 6 AND len(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')))) < len(ws) - 2 THEN 'repeated_ngram'
    WHEN regexp_matches(text, '\p{Nd}|[₹$€£¥%]') THEN 'unnormalized_number'
    WHEN length(regexp_replace(text, '[^\p{L}]', '', 'g')) = 0
      OR length(regexp_replace(regexp_replace(text, '[^\p{L}]', '', 'g'), '[^\x{41}-\x{24f}]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.9 THEN 'wrong_script'
    END AS fault,
    regexp_replace(regexp_replace(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'), '^ +| +$', '', 'g'), '\p{P}', '', 'g') AS key
  FROM w
), firsts AS (SELECT * FROM judged WHERE fault IS NULL QUALIFY row_number() OVER (PARTITION BY language, key ORDER BY seq) = 1)"""


def spoken(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as utterances: what was meant, and as transcript the next turn's text, both whole."""
    turns = t(spark, sf, "conversations")
    nexts = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("heard"))
    return turns.join(nexts, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("utt_id"), F.col("role").alias("language"), (F.col("conv_id") % 40).alias("speaker_id"),
        F.expr("CASE conv_id % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END").alias("gender"),
        "text", F.col("heard").alias("asr_transcript"), (F.length("heard") * F.lit(Decimal("0.08"))).alias("duration"),
    )


# DuckDB's levenshtein compares bytes: each character of a pair becomes the ASCII sign of its place in the pair's
# alphabet. A pair of over 126 characters would be an error, not a wrong distance.
SPOKEN = r"""spoken AS (
  SELECT a.conv_id * 100 + a.turn AS utt_id, a.role AS language, a.conv_id % 40 AS speaker_id,
    CASE a.conv_id % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS gender,
    a.text AS text, b.text AS asr_transcript, length(b.text) * 0.08 AS duration
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
), scored AS (
  SELECT *, trim(regexp_replace(regexp_replace(text, '[।.,?!"''()\[\]{}:;—…-]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS ref,
    trim(regexp_replace(regexp_replace(asr_transcript, '[।.,?!"''()\[\]{}:;—…-]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS hyp FROM spoken
), alphabet AS (SELECT *, list_distinct(list_concat(string_split(ref, ''), string_split(hyp, ''))) AS abc FROM scored
), mapped AS (
  SELECT * EXCLUDE (abc), CASE WHEN len(abc) > 126 THEN error('alphabet too large') ELSE array_to_string(list_transform(string_split(ref, ''), lambda c: chr(list_position(abc, c)::INT)), '') END AS r,
    array_to_string(list_transform(string_split(hyp, ''), lambda c: chr(list_position(abc, c)::INT)), '') AS h FROM alphabet
), cers AS (
  SELECT *, CASE WHEN length(ref) = 0 THEN CASE WHEN length(hyp) > 0 THEN 1.0 ELSE 0.0 END ELSE levenshtein(r, h) / length(ref) END AS cer,
    CASE WHEN length(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) > 0 THEN duration / length(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) END AS spc FROM mapped
), qc AS (
  SELECT *, coalesce(spc BETWEEN 0.04 AND 0.30, false) AS spc_ok, cer <= 0.8 AS cer_ok FROM cers
), done AS (SELECT *, spc_ok AND cer_ok AS qc_passed FROM qc)"""


def signals(spark: SparkSession, sf: str) -> DataFrame:
    """A user's events in order as a signal in 0 to 1."""
    events = t(spark, sf, "events").select("user_id", F.struct("ts", "event_id", F.least(F.col("value") / 250, F.lit(1.0)).alias("v")).alias("e"))
    return events.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["v"]).alias("x"))


SIGNALS = """sig AS (SELECT user_id, list(least(value / 250, 1.0) ORDER BY ts, event_id) AS x FROM events GROUP BY 1
), fr AS (
  SELECT *, list_transform(range(0, CASE WHEN len(x) < 8 THEN 1 ELSE 1 + (len(x) - 8) // 3 END), lambda i: x[3 * i + 1:3 * i + 8]) AS frames FROM sig
), lev AS (
  SELECT *, list_transform(frames, lambda f: sqrt(list_sum(list_transform(f, lambda v: v * v)) / len(f) + 1e-12)) AS levels,
    sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) AS rms FROM fr
)"""
