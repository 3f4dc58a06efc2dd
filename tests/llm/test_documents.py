"""Operators 2, 6, 7, 8, 9, 10 and the pipeline against plain versions."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tessera.llm import langid, merkle, ordinal, quality_rules, queries, simhash, warc
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.test_tokens import plain_best_fit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["odd", "small"])
def folder(request, odd_dir):
    return odd_dir if request.param == "odd" else SF_SMALL


def docs_of(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def plain_simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    values = np.array(prints, dtype=np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_op2(spark, folder):
    docs = docs_of(spark, folder)
    prints = [plain_simhash(t) for _, t in docs]
    roots = plain_components(prints)
    smallest: dict = {}
    for (d, _), r in zip(docs, roots):
        if d is not None:
            smallest[r] = min(d, smallest.get(r, d))
    want = Counter((d, f"{p:016x}", smallest.get(r)) for (d, _), p, r in zip(docs, prints, roots))
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in queries.op2_simhash_near_dedup(spark, folder).collect())
    assert got == want


def test_links_are_whole(spark):
    """Chains, dense balls and hubs of fingerprints, near in any place of the bits."""
    rng = np.random.default_rng(4)
    values = [int(x) for x in rng.integers(0, 2**64, 150, dtype=np.uint64)] + [0, 3, 2**64 - 1]
    for v in values[:40]:
        for _ in range(6):
            v ^= 1 << int(rng.integers(64))
            v ^= (1 << int(rng.integers(64))) * int(rng.integers(2))
            values.append(v)
    values += [values[0] ^ (1 << b) for b in range(64)]
    values = sorted(set(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "print long")).collect()
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links]
    want = {frozenset((a, b)) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2}
    assert len(pairs) == len(set(map(frozenset, pairs))) and set(map(frozenset, pairs)) == want
    found = {r.node: r.root for r in simhash.connected_components(spark.createDataFrame(links)).collect()}
    roots = plain_components(values)
    groups, mine = {}, {}
    for (s,), v, r in zip(signed, values, roots):
        groups.setdefault(r, set()).add(s)
        mine.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1))
def test_count_distance_is_a_lower_bound(a, b):
    counts = lambda x: [(x >> 2 * i & 3).bit_count() for i in range(32)]
    assert sum(abs(x - y) for x, y in zip(counts(a), counts(b))) <= (a ^ b).bit_count()


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_op6(spark, folder):
    want = Counter((d, *plain_rules(t)) for d, t in docs_of(spark, folder))
    rows = queries.op6_quality_rules(spark, folder).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)


def oracle(sql, folder, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con.execute(sql).df()


def test_op6_oracle(spark):
    order = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = oracle(quality_rules.ORACLE, SF_ORACLE, "documents")[order].sort_values("doc_id").values.tolist()
    assert sorted(queries.op6_quality_rules(spark, SF_ORACLE).toPandas()[order].values.tolist()) == want


def test_lines_go_by_their_own_rules(spark):
    good = [" ".join(f"plain{i}word{k}" for k in range(12)) + "." for i in range(6)]
    text = "\n".join([*good, "All rights reserved.", "Home | News | Sport | Mail", "no end", "BUY!! IT!! NOW!!", "It%%% is*** odd&&& here$$$ so."])
    row = quality_rules.judge_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.line_faults == ["boilerplate", "navigation", "punctuation", "shouting", "symbols"] and row.kept
    assert row.clean_text.split("\n") == text.split("\n")[:6]


def test_rules_keep_clashing_columns(spark):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(1, good, "mine", 5, "q", "v"), (2, "short", "mine", 6, "r", "w"), (3, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, _lines string, _verdict string")
    assert [tuple(r) for r in quality_rules.clean_documents(docs).collect()] == rows[:1]
    judged = quality_rules.judge_documents(docs)
    assert {r.doc_id: (r.kept, r.n_words, r._lines, r._verdict) for r in judged.collect()} == {1: (True, 80, "q", "v"), 2: (False, 1, "r", "w"), 3: (False, 0, None, None)}


def test_rules_are_worked_out_once(spark):
    """The plan has the rules in a generator only, neither in a filter nor in a projection."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality_rules.clean_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("cookie policy") == 1


def plain_edit(docs):
    order = sorted(docs, key=lambda d: -d[0])
    for (d, t), (_, n) in zip(order, order[1:] + order[:1]):
        third = len(t) // 3
        yield d, len(t), t[: len(t) - third] + n[:third]


def test_op7(spark, odd_dir, tmp_path):
    frame = spark.read.parquet(f"{odd_dir}/documents.parquet").filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), SF_ORACLE):
        docs = [(d, t or "") for d, t in docs_of(spark, folder)]
        rows = {r.doc_id: r for r in queries.op7_merkle_fingerprints(spark, folder).collect()}
        assert len(rows) == len(docs)
        by_text: dict = {}
        for d, n, edited in plain_edit(docs):
            r = rows[d]
            assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            by_text.setdefault(edited, set()).add(r.edited_fingerprint)
        for d, t in docs:
            by_text.setdefault(t, set()).add(rows[d].fingerprint)
        assert all(len(p) == 1 for p in by_text.values()) and len({next(iter(p)) for p in by_text.values()}) == len(by_text)
    assert np.mean([r.near_edited for r in rows.values()]) > 0.5 > 0.2 > np.mean([r.near_next for r in rows.values()])


def plain_leaves(text):
    out, start = set(), 0
    while start < len(text):
        end = min(len(text), start + merkle.LEAF)
        for i in range(start + 1, len(text) + 1):
            stop = re.match(rf"[.!?…।][ \t\n\f\r]+|[。！？]|[{merkle.CLOSING}] |\n", text[i:])
            if i - start > merkle.LEAF:
                break
            if stop or i == len(text):
                end = i + (stop.end() if stop else 0)
                break
        out.add(text[start:end])
        start = end
    return out


def plain_root(text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections, run = [], ""
    for paragraph in map(sha, text.split("\n")):
        closes = int(paragraph[:2], 16) % merkle.SECTION_MEAN == 0
        run += paragraph + ("" if closes else ",")
        if closes:
            sections.append(run)
            run = ""
    sections += [run] * bool(run)
    return sha("root:" + ",".join(sha("section:" + s) for s in sections))


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = plain_leaves(a), plain_leaves(b)
    size = sum(map(len, x)) + sum(map(len, y))
    return 2 * sum(map(len, x & y)) / size if size else 0.0


def test_op7_is_the_plain_tree(spark, odd_dir, tmp_path):
    frame = spark.read.parquet(f"{odd_dir}/documents.parquet").filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    more = [(1000, "日本語です。" * 40 + "終わり"), (1001, "x" * 900), (1002, "one long line without any sign " * 60), (1003, "a\n\nb"), (1004, "end. "), (1005, "a.\u00a0b")]
    frame.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), SF_SMALL):
        docs = sorted(((d, t or "") for d, t in docs_of(spark, folder)), key=lambda d: -d[0])
        rows = {r.doc_id: r for r in queries.op7_merkle_fingerprints(spark, folder).collect()}
        for (d, n, edited), (_, text), (_, following) in zip(plain_edit(docs), docs, docs[1:] + docs[:1]):
            r = rows[d]
            assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (n, plain_root(text), plain_root(edited))
            assert r.near_edited == plain_likeness(text, edited) and r.near_next == plain_likeness(text, following)
    assert rows and merkle.LEAF < 1 << merkle._LENGTH_BITS


def test_op7_finds_the_part_that_stayed(spark, tmp_path):
    """Two thirds stay, in texts of one line, without sentences and without spaces too."""
    rnd = np.random.default_rng(3)
    word = lambda: "".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    han = lambda: "".join(chr(0x4E00 + c) for c in rnd.integers(0, 20000, 12)) + "。"
    texts = [" ".join(word() for _ in range(300)) for _ in range(4)] + ["".join(han() for _ in range(60)) for _ in range(4)] + ["".join(word() for _ in range(900)) for _ in range(4)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert all(0.55 < r.near_edited < 0.75 and r.near_next < 0.1 for r in queries.op7_merkle_fingerprints(spark, str(tmp_path)).collect())


def test_op7_oracle(spark):
    order = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    want = oracle(merkle.ORACLE, SF_ORACLE, "documents")[order].sort_values("doc_id").values.tolist()
    assert sorted(queries.op7_merkle_fingerprints(spark, SF_ORACLE).toPandas()[order].values.tolist()) == want


def test_op7_keeps_repeated_rows(spark, odd_dir):
    assert queries.op7_merkle_fingerprints(spark, odd_dir).count() == len(docs_of(spark, odd_dir))


def test_op7_splits_a_hot_id(spark, monkeypatch):
    """Rows without an id, or with one id, go to several blocks, and each still finds its neighbour."""
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 20)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}. and more {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = merkle.with_next(docs).filter("not last").groupBy("block").count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 100
    found = merkle.fingerprint_edits(docs).collect()
    heads = Counter(r.edited_text[len(r.edited_text) - len(r.edited_text) // 3 :] for r in found)
    assert len(found) == 300 and sum(heads.values()) == 300


def test_tree_locates_an_edit(spark):
    lines = [f"paragraph {i}." for i in range(40)]
    other = lines[:17] + ["changed."] + lines[18:]
    frame = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(other))], "doc_id long, text string")
    a, b = merkle.fingerprint_tree(frame).orderBy("doc_id").collect()
    assert a.root != b.root and [i for i, (x, y) in enumerate(zip(a.paragraphs, b.paragraphs)) if x != y] == [17]
    assert len(set(a.sections) & set(b.sections)) >= 1


def test_op8(spark, tmp_path):
    rows = [(3, "u", "same"), (1, "v", "same"), (2, "w", None), (9, None, ""), (7, "x\r\ny", "é"), (None, "z", "same"), (5, "q", "é" * 50000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in queries.op8_warc_archive(spark, str(tmp_path)).collect()}
    assert got == {3: (4, "revisit", 1), 1: (4, "response", None), 2: (0, "response", None), 9: (0, "revisit", 2), 7: (2, "response", None), None: (4, "revisit", 1), 5: (100000, "response", None)}
    archive = warc.write_archive(spark.read.parquet(f"{tmp_path}/pages.parquet"), min_bytes=3)
    back = {r.page_id: r for r in warc.read_archive(spark, archive, payloads=True).collect()}
    assert back[9].record_type == "response" and bytes(back[3].payload) == b"same" == bytes(back[None].payload)
    record = {r.page_id: bytes(r.record) for r in warc.export_records(spark, archive).collect()}
    head, _, block = record[7].partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and block == "é".encode() + b"\r\n\r\n" and b"Content-Length: 2" in head


def strict_records(data):
    """Records of WARC bytes: (headers, block); every rule of the form that a reader may count on is checked."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        pairs = [line.split(": ", 1) for line in lines]
        headers = dict(pairs)
        assert version == "WARC/1.1" and len(headers) == len(pairs) and all(re.fullmatch(r"[A-Za-z-]+", k) for k in headers)
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", headers["WARC-Date"]) and re.fullmatch(r"<urn:[^<>\s]+>", headers["WARC-Record-ID"])
        at = end + 4 + int(headers["Content-Length"])
        yield headers, data[end + 4 : at]
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4


def test_op8_hostile_urls(spark, tmp_path):
    """Urls with line ends of every kind, and rows that share an id or have none."""
    evil = ["u\r\nWARC-Refers-To: <urn:tessera:page:5:0>", "u\u2028WARC-Refers-To: <urn:tessera:page:5:0>", "u\x85WARC-Payload-Digest: sha1:X", "u\nWARC-Type: revisit", "u\x0bWARC-Type: revisit", "a b\u2029c", "", None]
    rows = [(i, u, f"text {i % 6}", "clash", 3) for i, u in enumerate(evil)] + [(2, "again", "text 2", "", 0), (None, "none", "text 9", "", 0), (None, "none", "text 9", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, row int").repartition(3)
    archive = warc.write_archive(pages)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archive(spark, archive).collect()), key=repr)
    want = [(i, "response", None, 6) for i in range(6)] + [(6, "revisit", 0, 6), (7, "revisit", 1, 6), (2, "revisit", 2, 6), (None, "response", None, 6), (None, "revisit", None, 6)]
    assert got == sorted(want, key=repr)
    records = list(strict_records(b"".join(bytes(r.record) for r in warc.export_records(spark, archive).collect())))
    ids = {h["WARC-Record-ID"]: h for h, _ in records}
    assert len(ids) == len(rows) == len(records)
    for headers, block in records:
        if headers["WARC-Type"] == "revisit":
            first = ids[headers["WARC-Refers-To"]]
            assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == headers["WARC-Payload-Digest"] and not block
    assert {h["WARC-Target-URI"] for h, _ in records} >= {"u%0D%0AWARC-Refers-To:%20<urn:tessera:page:5:0>", "u%E2%80%A8WARC-Refers-To:%20<urn:tessera:page:5:0>", "a%20b%E2%80%A9c", ""}


def test_op8_long_payloads(spark, tmp_path):
    rows = [(i, f"u{i}", ("é" * 600_000 + str(i % 2)) if i < 4 else None) for i in range(6)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    back = {r.page_id: (bytes(r.payload).decode(), r.refers_to) for r in warc.read_archive(spark, archive, payloads=True).collect()}
    assert back == {i: (t or "", {2: 0, 3: 1, 5: 4}.get(i)) for i, _, t in rows}


def test_op8_oracle(spark):
    order = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = lambda frame: frame.sort_values("page_id")[order].fillna({"refers_to": -1}).astype({"refers_to": int}).values.tolist()
    assert plain(queries.op8_warc_archive(spark, SF_ORACLE).toPandas()) == plain(oracle(warc.ORACLE, SF_ORACLE, "pages"))


def test_op9(spark, odd_dir):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").toPandas().set_index("doc_id")
    got = queries.op9_language_id(spark, SF_ORACLE).toPandas().set_index("doc_id")
    assert set(got.lang_pred) <= set(docs.lang) | {"und"} and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang_pred == docs.lang.reindex(held.index)).mean() > 0.97
    odd = queries.op9_language_id(spark, odd_dir).toPandas()
    plain = {d: t for d, t in docs_of(spark, odd_dir)}
    for r in odd.itertuples():
        text = plain[None if r.doc_id != r.doc_id else int(r.doc_id)]
        assert (r.lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = " " + re.sub(" +", " ", letters).lstrip(" ")
    return [(k, padded[i : i + k]) for k in langid.SIZES for i in range(len(padded) - k + 1)] if any(c.isalpha() for c in text) else None


def test_op9_is_the_plain_sets(spark):
    """The filter's predictions against exact sets of n-grams, learned from the same rows by plain counting."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, langid.train(docs.filter("doc_id % 3 <> 0"))).collect()}
    counts, rows = {}, docs.collect()
    for r in rows:
        if r.doc_id % 3:
            for k, g in plain_grams(r.text) or []:
                counts.setdefault((r.lang, k), Counter())[g] += 1
    sets = {}
    for (lang, k), c in counts.items():
        least = sum(c.values()) * langid.LEAST_SHARE
        sets.setdefault(lang, set()).update((k, g) for g, n in c.items() if n >= least)
    apart = []
    for r in rows:
        grams = plain_grams(r.text)
        hits = {lang: sum(g in s for g in grams) for lang, s in sets.items()}
        best, second = sorted(hits.values(), reverse=True)[:2]
        if best > second:
            assert got[r.doc_id][0] == max(hits, key=hits.get)
        apart.append(abs(got[r.doc_id][1] - best / (best + second)))
    assert len(apart) == len(rows) and np.mean(apart) < 0.002 and max(apart) < 0.1


def test_long_texts_are_read_in_slices(monkeypatch):
    text = ("Das ist ein langer Text, und The cat sat. " * 50 + "Straße ΑΣ ") * 3
    whole = [list(langid.gram_blocks(text)), simhash.simhash(text)]
    monkeypatch.setattr(langid, "BLOCK", 100)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    parts = list(langid.gram_blocks(text))
    assert len(parts) > 20 and simhash.simhash(text) == whole[1]
    for size in langid.SIZES:
        assert np.array_equal(np.concatenate([h for k, h in parts if k == size]), np.concatenate([h for k, h in whole[0] if k == size]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["abc", "über alles", "été à", "123", "日本語"]), max_size=6))
def test_filter_has_no_false_negatives(parts):
    hashes = np.concatenate([langid.grams(langid.normal(" ".join(parts)), s) for s in langid.SIZES])
    model = langid.build({f"l{i}": hashes if i == 70 else hashes[:0] for i in range(80)})
    assert langid.predict(model, " ".join(parts))[0] in ("und", "l70", "l0")
    if len(hashes):
        assert langid.predict(model, " ".join(parts))[0] == "l70"


def test_op10(spark, odd_dir, empty_dir):
    """Half of the labels teach, the other half judge."""
    docs, labels = (spark.read.parquet("/root/testdata/sf0.1/" + t + ".parquet") for t in ("documents", "labels"))
    model = ordinal.train(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("doc_id", "text")
    rows = ordinal.score_documents(held, model).toPandas().merge(labels.toPandas(), on="doc_id").merge(held.toPandas(), on="doc_id")
    insults = rows.text.str.contains(r"\b(?:idiot|moron|scum|stupid|worthless|pathetic)\b", case=False)  # a third of toxic labels are noise
    good = (rows.quality == 1) & (rows.toxic == 0)
    assert rows.selected[good].mean() > 0.97 and rows.selected[rows.quality == 0].mean() < 0.03 and rows.selected[insults & (rows.toxic == 1)].mean() < 0.2
    assert rows.expected_grade.between(0, 2).all() and (rows.p_best <= rows.p_above_worst + 1e-12).all()
    nothing = ordinal.train(docs, spark.read.parquet(f"{empty_dir}/labels.parquet"))
    assert ordinal.score_documents(spark.read.parquet(f"{odd_dir}/documents.parquet"), nothing).filter("selected").count() == len(docs_of(spark, odd_dir))


def small_rated(n=60, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        grade = int(rng.integers(0, 3))
        tell = {0: [1, 2], 1: [3], 2: [4]}[grade]
        rows.append((grade, np.unique(np.concatenate([rng.choice(tell, 1), rng.integers(10, 30, 6)])).astype(np.int32)))
    return rows


def plain_objective(theta, used, rows):
    """Penalised mean loss of proportional odds, row by row; theta: first threshold, log gap, weights of used."""
    cuts, weight, total = [theta[0], theta[0] + np.exp(theta[1])], dict(zip(used, theta[2:])), 0.0
    below = lambda cut, s: 1 / (1 + np.exp(-(cut - s)))
    for grade, features in rows:
        s = sum(weight.get(int(f), 0.0) for f in features)
        p = [below(cuts[0], s), below(cuts[1], s) - below(cuts[0], s), 1 - below(cuts[1], s)][grade]
        total -= np.log(p)
    return total / len(rows) + ordinal.PENALTY / len(rows) / 2 * float(np.sum(np.square(theta[2:])))


def test_op10_fit_is_the_least_loss():
    """At the fitted model the plain objective's slope is nil in every direction, and no small step lowers it."""
    rated = small_rated()
    rows = ordinal.Rows(np.array([g for g, _ in rated]), np.concatenate([f for _, f in rated]).astype(np.int64), np.repeat(np.arange(len(rated)), [len(f) for _, f in rated]))
    told = ordinal.evidence(rows) > 1.0
    model = ordinal.learn(rows, told, 3000)
    used = np.flatnonzero(told)
    theta = np.concatenate(([model.thresholds[0], np.log(model.thresholds[1] - model.thresholds[0])], model.weights[used]))
    at, rng = plain_objective(theta, used, rated), np.random.default_rng(1)
    assert len(used) >= 4 and np.isclose(at - ordinal.PENALTY / 60 / 2 * np.sum(theta[2:] ** 2), ordinal.loss(model, rows))
    for i in range(len(theta)):
        step = np.eye(len(theta))[i] * 1e-4
        assert abs(plain_objective(theta + step, used, rated) - plain_objective(theta - step, used, rated)) / 2e-4 < 2e-3
    assert all(plain_objective(theta + 0.05 * rng.normal(size=len(theta)), used, rated) > at for _ in range(40))


def test_op10_scores_are_the_plain_ones(spark, odd_docs):
    """Every document's grades by the plain formula over its words."""
    model = ordinal.train(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), spark.read.parquet(f"{SF_ORACLE}/labels.parquet"))
    docs = odd_docs.select("doc_id", "text").union(spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 5000", "text"))
    plain = []
    for d, text in docs.collect():
        words, text = (text or "").split(), text or ""
        n = max(1, len(words))
        names = {p for w in words for p in re.findall(r"\w+|[^\w\s]+", w.lower())}
        names |= {f" distinct {10 * len(set(words)) // n}", f" signs {min(5, 5 * sum(text.count(c) for c in '#*$%&|<>!') // n)}", f" length {len(words).bit_length()}"}
        names |= {f" capitals {5 * sum(w.isupper() for w in set(words)) // max(1, len(set(words)))}"}
        s = sum(model.weights[b] for b in {xxhash.xxh32_intdigest(x.encode()) % ordinal.BUCKETS for x in names})
        above = [1 - 1 / (1 + np.exp(-(c - s))) for c in model.thresholds]
        plain.append((-1 if d is None else d, round(sum(above), 6), round(above[1], 6), bool(above[1] >= ordinal.SELECT_FROM)))
    rows = ordinal.score_documents(docs, model).collect()
    assert sorted(plain) == sorted((-1 if r.doc_id is None else r.doc_id, round(r.expected_grade, 6), round(r.p_best, 6), r.selected) for r in rows)
    kept = Counter(r.text for r in ordinal.select_documents(odd_docs, model).collect())
    assert sum(kept.values()) == sum(p[3] for p in plain[: odd_docs.count()]) and ordinal.select_documents(odd_docs, model).schema == odd_docs.schema


@pytest.mark.parametrize("folder", [SF_SMALL, SF_ORACLE])
def test_op10_learns_from_few_labels(spark, folder):
    """From 87 and from 399 labels: most poor documents of a larger table go, most toxic ones too, and good ones stay."""
    insults = r"\b(?:idiot|moron|scum|stupid|worthless|pathetic|loser|trash|disgusting)\b"
    model = ordinal.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    docs, labels = (spark.read.parquet("/root/testdata/sf0.1/" + t + ".parquet") for t in ("documents", "labels"))
    rows = ordinal.score_documents(docs, model).toPandas().merge(labels.toPandas(), on="doc_id").merge(docs.select("doc_id", "text").toPandas(), on="doc_id")
    good, toxic = (rows.quality == 1) & (rows.toxic == 0), (rows.quality == 1) & (rows.toxic == 1) & rows.text.str.contains(insults, case=False)
    assert rows.selected[good].mean() > 0.97 and rows.selected[rows.quality == 0].mean() < 0.06 and rows.selected[toxic].mean() < 0.5


def test_op10_repeated_labels_and_ids(spark):
    """A third of the labels, and of the documents, may share one id: the sample stays bounded and the model the same in kind."""
    docs = spark.createDataFrame([(i % 40, f"{'good words here' if i % 2 else 'bad junk'} {i}") for i in range(400)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 1, 0)] * 30 + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = ordinal.train(docs, labels, sample=50)
    found = {r.doc_id: r.selected for r in ordinal.score_documents(docs.dropDuplicates(["doc_id"]), model).collect() if r.doc_id is not None}
    assert found == {i: bool(i % 2) for i in range(40)}


@pytest.mark.parametrize("name", ["op2_simhash_near_dedup", "op6_quality_rules", "op7_merkle_fingerprints", "op8_warc_archive", "op9_language_id", "op10_quality_classifier"])
def test_empty(spark, empty_dir, name):
    assert getattr(queries, name)(spark, empty_dir).count() == 0


def plain_pipeline(spark, rows, labels_dir):
    """doc_ids and texts that plain versions of the first three stages keep; the classifier's model is the operator's."""
    judged = quality_rules.judge_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    cleaned = [(r.doc_id, r.clean_text) for r in judged if r.kept]
    model = ordinal.train(spark.read.parquet(f"{labels_dir}/documents.parquet"), spark.read.parquet(f"{labels_dir}/labels.parquet"))
    chosen = [r.selected for r in ordinal.score_documents(spark.createDataFrame(cleaned, "doc_id long, text string").coalesce(1), model).collect()]
    return [row for row, good in zip(cleaned, chosen) if good]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, repeated rows, clashing columns: no text is lost and no group keeps two."""
    from tests.llm.test_copies import plain_groups

    texts = [" ".join(f"{a}{i}x{k}" for k in range(70)) + "." for i, a in enumerate(["red", "green", "blue", "grey", "pink"])]
    near = texts[4].replace("pink4x3 ", "other ")
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (1, texts[3]), (1, texts[4]), (1, texts[4]), (7, texts[0]), (None, near), (2, None), (3, ""), (None, "short")]
    full = [(*r, "mine", 5, "c", "v") for r in rows]
    spark.createDataFrame(full, "doc_id long, text string, kept string, n_words int, _row_key string, _verdict string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        columns, docs = docs.columns, stage(spark, docs, str(tmp_path))
        assert docs.columns == columns and all(r.kept == "mine" and r.n_words == 5 and r._verdict == "v" for r in docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in docs.collect()) == sorted([(7, texts[0]), (-1, texts[1]), (-1, texts[2]), (1, texts[3]), (1, texts[4])])
    groups, _ = plain_groups([texts[0], texts[0], texts[4], near])
    assert groups == [0, 0, 2, 2]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in out) == Counter([7, None, None, 1, 1])


def test_pipeline(spark, empty_dir):
    from tests.llm.test_copies import plain_groups

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = plain_pipeline(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], SF_SMALL)
    rows = sorted(rows)
    groups, _ = plain_groups([t for _, t in rows])
    want = {rows[g][0] for g in set(groups)}
    columns, kept = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = stage(spark, kept, SF_SMALL)
        assert kept.columns == columns
        after = {r.doc_id: r.text for r in kept.collect()}
        assert set(after) < set(before) and len(after) == kept.count()
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    out = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert set(out.doc_id) == set(after) == want
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() == plain_best_fit(out.length.tolist(), 2048)
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_screens_are_tried_with_one_fold_in_memory():
    import tracemalloc

    import numpy as np

    from tessera.llm import ordinal

    r = np.random.default_rng(4)
    owner = np.repeat(np.arange(2000), 150)
    rows = ordinal.Rows(r.integers(0, 3, 2000), r.integers(0, ordinal.BUCKETS, len(owner)), owner)
    tracemalloc.start()
    found = ordinal.best_screen(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(peak / (rows.flat.nbytes + rows.owner.nbytes))
    assert found in ordinal.SCREENS and peak < 5.5 * (rows.flat.nbytes + rows.owner.nbytes)
