"""The pipeline's near-dedup stage against plain similarities."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import copies, simhash
from tests.conftest import SF_ORACLE
from tests.llm.test_documents import WORD, plain_components, plain_simhash


def plain_similarity(a, b):
    words = [(t or "").lower().split() for t in (a, b)]
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words)
    return len(x & y) / len(x | y)


def planted():
    """(doc_id, text) of 40 texts, each with a copy of 0.8 to 0.95 and one below 0.8, and all with a common passage."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    common, rows, near = " ".join(word() for _ in range(12)), [], {}
    for i in range(40):
        words = [word() for _ in range(200)]
        rows.append((i, " ".join(words) + " " + common))
        for k, changes in ((100, 1 + i % 4), (200, 12)):
            edited = list(words)
            for place in range(changes):
                edited[place * 15 + 7] = word()
            rows.append((k + i, " ".join(edited) + " " + common))
            near[k + i] = plain_similarity(rows[-1][1], next(t for d, t in rows if d == i))
    return rows, near


def test_stage_drops_planted_copies(spark):
    rows, near = planted()
    assert all(0.8 <= j <= 0.96 for d, j in near.items() if d < 200) and all(j < 0.8 for d, j in near.items() if d >= 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_ORACLE).collect()}
    assert kept == {d for d, _ in rows if not 100 <= d < 200}


def plain_groups(texts):
    """The least place of each text's component: fingerprints within two bits, or a similarity of 0.8 or more."""
    parent = plain_components([plain_simhash(t) for t in texts])
    words = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()} for w in words]
    near = lambda x, y: x and y and 10 * min(len(x), len(y)) >= 8 * max(len(x), len(y)) and 10 * len(x & y) >= 8 * len(x | y)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if near(sets[i], sets[j])]

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, j in links:
        i, j = find(i), find(j)
        parent[max(i, j)] = min(i, j)
    return [find(i) for i in range(len(texts))], links


def kept_places(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return {r.doc_id for r in copies.one_of_each(docs).collect()}


def test_groups_are_whole(spark):
    """One document stays of each group of the plain version, on the documents table."""
    rows = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").sort("doc_id").collect()
    groups, links = plain_groups([r.text for r in rows])
    assert links and {rows[i].doc_id for i in set(groups)} == {r.doc_id for r in copies.one_of_each(spark.createDataFrame(rows)).collect()}


def test_large_groups_and_chains(spark):
    """A group of near copies that aren't all near each other, a chain, a common passage, and short texts."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base, passage = [word() for _ in range(160)], " ".join(word() for _ in range(60))
    texts = []
    for i in range(70):
        w = list(base)
        for place in rnd.sample(range(160), 1 + i % 2):
            w[place] = word()
        texts.append(" ".join(w))
    chain = [word() for _ in range(150)]
    for i in range(12):
        chain = list(chain)
        chain[(i * 17) % 150] = word()
        chain[(i * 17 + 60) % 150] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(40)) + " " + passage for _ in range(50)]
    texts += ["a b", "a b", "c d e", "c d e f", "", None, "A  b", passage, passage + " x"]
    groups, links = plain_groups(texts)
    assert len(links) > 900 and len(set(groups)) < 70
    assert kept_places(spark, texts) == set(groups)


def test_families_in_blocks(spark, monkeypatch):
    """The same groups where buckets count as heavy and families have several blocks."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base, texts = [word() for _ in range(120)], []
    for i in range(90):
        w = list(base)
        for place in rnd.sample(range(120), 1 + i % 4):
            w[place] = word()
        texts.append(" ".join(w))
    texts += [" ".join(base[:60] + [word() for _ in range(60)]) for _ in range(10)] + [t for _, t in planted()[0][:30]]
    groups, links = plain_groups(texts)
    assert 1 < len(set(groups)) < len(texts) - 40
    monkeypatch.setattr(copies, "LEAST_HEAVY", 5)
    monkeypatch.setattr(copies, "BLOCK_TEXTS", 16)
    monkeypatch.setattr(copies, "COLUMNS", 50)
    assert kept_places(spark, texts) == set(groups)


def test_copies_in_a_table_larger_than_a_broadcast(spark, monkeypatch):
    rows, _ = planted()
    monkeypatch.setattr(copies, "BROADCAST_ROWS", 0)
    assert kept_places(spark, [t for _, t in rows]) == set(plain_groups([t for _, t in rows])[0])


def one_each(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()), key=repr)


def test_null_and_repeated_ids_keep_their_texts(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in ("red", "green", "blue"))
    assert one_each(spark, [(None, a), (None, b), (None, a), (1, c)]) == sorted([(None, a), (None, b), (1, c)], key=repr)
    assert one_each(spark, [(7, a), (7, b), (7, b), (3, a)]) == [(3, a), (7, b)]
    assert one_each(spark, [(None, a), (4, a), (None, None), (None, "")])[0] == (4, a)


def test_stage_on_odd_documents(spark, odd_docs):
    """Each component of the plain version keeps exactly one document, and no column changes."""
    texts = [r.text for r in odd_docs.collect()]
    prints = [plain_simhash(t) for t in texts]
    of = dict(zip(texts, plain_components(prints)))
    kept = [of[r.text] for r in simhash.one_of_each(odd_docs).collect()]
    assert sorted(kept) == sorted(set(of.values()))
    groups, _ = plain_groups(texts)
    of = dict(zip(texts, groups))
    stage = corpus_pipeline.drop_near_duplicates(spark, odd_docs, SF_ORACLE)
    assert sorted(of[r.text] for r in stage.collect()) == sorted(set(of.values())) and stage.schema == odd_docs.schema


def test_stage_on_an_empty_table(spark, odd_docs):
    assert corpus_pipeline.drop_near_duplicates(spark, odd_docs.limit(0), SF_ORACLE).count() == 0


def test_exploded_tables_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as small as the files that they come from; components stay whole either way."""
    rnd = random.Random(6)
    near = [rnd.getrandbits(60) ^ (1 << rnd.randrange(60)) for _ in range(200)]
    values = sorted({*near, *(p ^ (1 << rnd.randrange(60)) for p in near), *(near[0] ^ (1 << i) for i in range(40))})
    prints = simhash.persist_table(spark.createDataFrame([(p, i) for i, p in enumerate(values)], "print long, doc_id long"), "prints")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan(simhash.near_links(prints.select("print")))
    least = plain_components(values)
    for few in (simhash.FEW, 0):
        monkeypatch.setattr(simhash, "FEW", few)
        found = {r.p: r.component_id for r in simhash.components(prints).collect()}
        assert [found[p] for p in values] == least
    table = prints.select(F.col("print").alias("u"), F.col("doc_id").alias("m"))
    assert "Broadcast" not in plan(simhash._salted(table.withColumn("v", F.col("u")).drop("m"), "u", "v", table, 1))


def test_sketches_rule_out_no_near_copy():
    """They differ in no more cells than the sets in shingles, whatever their sizes, and in nearly as many."""
    rnd = np.random.default_rng(8)
    sets = []
    for n in (1, 3, 31, 33, 200, 513, 3000, 70_000):
        base = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        sets += [base] + [np.unique(np.concatenate([base[int(n * cut) :], rnd.integers(0, 1 << 63, int(n * cut), dtype=np.uint64)])) for cut in (0.1, 0.3)] + [base[: -(-n * 17 // 20)]]
    sketches, n = [copies.sketch(x) for x in sets], np.array([len(x) for x in sets])
    apart = np.array([[len(np.setxor1d(a, b)) for b in sets] for a in sets])
    differ = np.array([[copies.differing(a, b) for b in sketches] for a in sketches])
    assert (differ <= apart).all()
    seen = copies.possible(sketches, sketches, n, n)
    near = np.array([[copies.similar(a, b) for b in sets] for a in sets])
    assert (seen >= near).all() and seen[near].all() and not seen[8, 10]
    by_pairs = copies.may_be_near(differ, n[:, None] + n[None, :])
    assert (by_pairs[seen]).all() and (by_pairs >= near).all()


def test_only_texts_that_sketches_allow_move(spark, monkeypatch):
    """Texts with half their words in common meet in buckets, but none of them is read to compare it."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(100)]
    texts = [" ".join(base + [word() for _ in range(100)]) for _ in range(30)]
    moved, plain = [], copies.texts_of
    monkeypatch.setattr(copies, "LEAST_HEAVY", 5)
    monkeypatch.setattr(copies, "texts_of", lambda docs, wanted: moved.append(wanted.count()) or plain(docs, wanted))
    assert kept_places(spark, texts) == set(range(30)) and moved and not any(moved)


def test_exploded_tables_of_near_copies_are_not_broadcast(spark):
    texts = spark.createDataFrame([(k, k % 3, "some text") for k in range(9)], "key long, group long, text string")
    pairs = texts.select(F.col("key").alias("ka"), (8 - F.col("key")).alias("kb"))
    plan = copies.with_both(pairs, copies.persist_table(texts, "texts"), {"text": "t"})._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan
