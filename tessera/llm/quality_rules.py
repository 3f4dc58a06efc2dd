"""Line-first quality rules, in DataFrame expressions only.

Every line of a text is judged by itself: it fails as navigation (separator
signs), as symbols (signs in place of words), as shouting (doubled exclamation
marks or capitals), as boilerplate (licence, cookie and sign-in phrases) or
for want of final punctuation. Failing lines are removed; a document goes if
its base rules fail or if the lines kept hold too small a share of its word
characters. One row in, one row out, nothing shuffled.

A null text has no words. Blank lines are neither judged nor kept. Texts of any
length, repeated rows and empty tables need no special care. judge_documents
replaces columns that have the name of a result; clean_documents keeps every
column of its input as it is but for the cleaned text and its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh_name

WHITE, WHITE_CLASS = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: A document's shares: lines kept must hold so much of its word characters.
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_KEPT = 50, 50, 0.5
#: A line fails if more than so many of its words for each hundred break the rule.
SEPARATORS_PERCENT, SYMBOLS_PERCENT, SHOUTS_PERCENT = 15, 30, 30
#: A line of so many words is prose even without final punctuation.
PROSE_WORDS = 12
FINAL = r"[.!?:;…。！？।][\"'”’»)\]]*$"
SEPARATOR_WORD = r"(?:^| )[|>»·•/\\-]+(?= |$)"
SHOUT_WORD = r"!!+|(?:^|[ ])[\p{Lu}]{4,}(?=[ .,!]|$)"
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|licensed under|released under the|under the terms of|terms of (?:use|service)|privacy policy|"
    r"cookie policy|uses? cookies|enable javascript|sign in|log in|subscribe (?:now|to)|click here|powered by|copyright (?:\(c\)|©)|©)"
)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body) -> Column:
    """Evaluate value once for each row and use it as often as body likes."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_CLASS + "+"))


def repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash; most texts repeat none and stop at
    the distinct count, others sort (hash, place) and mark equal neighbours.
    """

    def marked(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, covered))

    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return let(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(let(hashed(w), marked))).cast("long")


def line_fault(line: Column) -> Column:
    """Why a line with words fails, or null."""

    def of(n: Column) -> Column:
        over = lambda pattern, percent: 100 * F.regexp_count(line, F.lit(pattern)) > percent * n
        return (
            F.when(over(SEPARATOR_WORD, SEPARATORS_PERCENT), "navigation")
            .when(line.rlike(SYMBOLS) & over(SYMBOLS + "+", SYMBOLS_PERCENT), "symbols")
            .when(over(SHOUT_WORD, SHOUTS_PERCENT), "shouting")
            .when(line.rlike(BOILERPLATE), "boilerplate")
            .when((n < PROSE_WORDS) & ~line.rlike(FINAL), "punctuation")
        )

    return let(F.regexp_count(line, F.lit(r"[^ ]+")), of)


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, WHITE_CLASS + "+", "")).cast("long")


def verdict(text: Column) -> Column:
    """struct of the counts, base_failed, clean_text, line_faults, kept_chars and kept for a text; a null text is empty."""
    bare = lambda line: F.trim(line, F.lit(WHITE))

    def judged(words: Column, lines: Column, repeats: Column, whole: Column) -> Column:
        clean = F.array_join(F.transform(F.filter(lines, lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n")
        n_words = F.size(words).cast("long")
        failed = (n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n_words)

        def of(clean_text: Column) -> Column:
            kept_chars = word_chars(clean_text)
            return let(kept_chars, lambda k: F.struct(
                n_words.alias("n_words"), whole.alias("word_chars"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(F.transform(lines, lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
                repeats.alias("n_repeat_words"), clean_text.alias("clean_text"),
                F.array_compact(F.transform(lines, lambda x: x["fault"])).alias("line_faults"),
                failed.alias("base_failed"), k.alias("kept_chars"), (~failed & (k >= LEAST_KEPT * whole)).alias("kept"),
            ))

        return let(clean, of)

    lines = F.filter(F.split(text, "\n"), lambda line: bare(line) != "")
    lines = F.transform(lines, lambda line: F.struct(line.alias("line"), line_fault(bare(line)).alias("fault")))
    return let(words_of(text), lambda w: let(lines, lambda x: let(repeated_words(w), lambda r: let(word_chars(text), lambda n: judged(w, x, r, n)))))


def judged_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs and a struct column of their verdicts, and its name, which docs doesn't have.

    The verdict goes through a generator of one row, so that neither a filter
    on it nor several of its fields work it out again.
    """
    name = fresh_name(docs, "_verdict")
    found = F.array(verdict(F.coalesce(docs["text"], F.lit(""))))
    return docs.select("*", F.explode(found).alias(name)), name


def judge_documents(docs: DataFrame) -> DataFrame:
    """Adds the counts, base_failed, clean_text, line_faults (array, a fault for each removed line), kept_chars and kept.

    Columns of docs that have one of these names are replaced.
    """
    judged, name = judged_rows(docs)
    fields = judged.schema[name].dataType.names
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in fields]
    return judged.select(*own, f"{name}.*")


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their failing lines, in the columns of docs: only text and n_chars change."""
    judged, name = judged_rows(docs)
    clean = F.col(f"{name}.clean_text")
    own = {"text": clean, "n_chars": F.char_length(clean).cast(docs.schema["n_chars"].dataType if "n_chars" in docs.columns else "long")}
    return judged.filter(f"{name}.kept").select(*[own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns])


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, tri) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 3) AS s(k) GROUP BY r),
l0 AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
l AS (SELECT r, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM l0),
lines AS (
  SELECT r, line, b, len(list_filter(string_split(b, ' '), lambda x: x <> '')) AS n FROM l WHERE b <> ''
),
fault AS (
  SELECT r, line,
    100 * len(list_filter(string_split(b, ' '), lambda x: regexp_full_match(x, '[|>»·•/\\-]+'))) > {SEPARATORS_PERCENT} * n
    OR 100 * len(regexp_extract_all(b, '[#*$%&|<>]+')) > {SYMBOLS_PERCENT} * n
    OR 100 * (len(regexp_extract_all(b, '!!+')) + len(list_filter(string_split(b, ' '), lambda x: regexp_matches(x, '^\p{{Lu}}{{4,}}([.,!]|$)')))) > {SHOUTS_PERCENT} * n
    OR regexp_matches(b, '{BOILERPLATE}')
    OR n < {PROSE_WORDS} AND NOT regexp_matches(b, '[.!?:;…。！？।]["''”’»)\]]*$') AS bad
  FROM lines
),
k AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup,
    coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (WHERE NOT bad), 0) AS kept_chars
  FROM fault GROUP BY r
),
f AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(kept_chars, 0) AS kept_chars
  FROM d JOIN w USING (r) LEFT JOIN k USING (r) LEFT JOIN rep USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words) AND kept_chars >= {LEAST_KEPT} * word_chars AS kept
FROM f
"""
