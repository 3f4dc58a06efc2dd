"""Every query with SQL gives the SQL's rows; the others are held against plain Python."""

import math

import duckdb
import pytest

from tessera import queries as Q
from tessera.plans.fixtures import candidates
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else v


def rows_of(frame):
    columns = sorted(frame.columns)
    return columns, sorted((tuple(map(cell, r)) for r in frame[columns].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, duck, name):
    assert rows_of(Q.QUERIES[name](spark, SF_SMALL).toPandas()) == rows_of(duck.execute(Q.ORACLE[name]).df())


def test_accept_without_vectors_is_the_plain_loop(spark):
    from pyspark.sql import functions as F

    from tessera.operators.dedup import accept_in_order

    judged = Q._judged(spark, SF_SMALL)
    rows = sorted(judged.select("seq", "language", "source", "kind", "key", "fault").collect())
    keys, filled, want = set(), {}, {}
    for r in rows:
        at = (r.language, r.source, r.kind)
        if filled.get(at, 0) >= 13:
            continue
        if r.fault is None and (r.language, r.key) not in keys:
            keys.add((r.language, r.key))
            filled[at] = filled.get(at, 0) + 1
            want[r.seq] = "accepted"
        else:
            want[r.seq] = r.fault or "exact_duplicate"
    blind = judged.withColumns({"cell": F.concat_ws("|", "language", "source", "kind"), "vector": F.lit(None).cast("array<float>")})
    assert {r.seq: r.outcome for r in accept_in_order(blind, 13, 0.92).collect()} == want


def test_greedy_accept_near_duplicates(spark):
    from tessera.operators.dedup import accept_in_order

    rows = [(1, "a", "c", "k1", None, [1.0, 0.0]), (2, "a", "c", "k2", None, [0.99, 0.1]), (3, "a", "c", "k1", None, [0.0, 1.0]), (4, "b", "c", "k1", None, [1.0, 0.0]), (5, "a", "c", "k5", None, None)]
    frame = spark.createDataFrame(rows, "seq long, language string, cell string, key string, fault string, vector array<float>")
    got = {r.seq: r.outcome for r in accept_in_order(frame, 5, 0.92).collect()}
    assert got == {1: "accepted", 2: "near_duplicate", 3: "exact_duplicate", 4: "accepted", 5: "accepted"}


def test_greedy_accept_compares_vectors(spark):
    """The plain loop with the cosine check."""
    import numpy as np

    from tessera.functions import models

    encode = models.stub_embedder()
    rows = sorted(Q._judged(spark, SF_SMALL).select("seq", "language", "source", "kind", "key", "fault", "text").collect())
    keys, vectors, filled, want = set(), {}, {}, {}
    for r in rows:
        at = (r.language, r.source, r.kind)
        if filled.get(at, 0) >= 13:
            continue
        want[r.seq] = r.fault or ("exact_duplicate" if (r.language, r.key) in keys else None)
        if want[r.seq] is None:
            v, others = np.array(encode(r.text), dtype=np.float32), vectors.setdefault(r.language, [])
            if others and max(float(v @ o) for o in others) >= 0.92:
                want[r.seq] = "near_duplicate"
                continue
            keys.add((r.language, r.key))
            others.append(v)
            filled[at] = filled.get(at, 0) + 1
            want[r.seq] = "accepted"
    assert "near_duplicate" in want.values()
    assert {r.seq: r.outcome for r in Q.greedy_accept(spark, SF_SMALL).collect()} == want


def test_errors_stay_with_their_rows(spark):
    """A row that a model can't do has its error; the others have their values."""
    from tessera.functions import models

    voice = models.plug(models.stub_synthesizer, "array<float>")
    rows = spark.createDataFrame([(1, "abc"), (2, ""), (3, "x")], "id int, s string").select("id", voice("s").alias("v")).collect()
    assert {r.id: (r.v.error, r.v.value and len(r.v.value)) for r in rows} == {1: (None, 2880), 2: ("ValueError: nothing to say", None), 3: (None, 960)}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_cer_is_the_plain_distance_of_whole_texts(spark):
    rows = Q._scored(spark, SF_SMALL).selectExpr("text", "asr_transcript", "cer").collect()
    plain = lambda t: " ".join("".join(" " if c in "।.,?!\"'()[]{}:;-—…" else c for c in t).split())
    pairs = [(plain(r.text), plain(r.asr_transcript), r.cer) for r in rows]
    assert max(len(a) for a, _, _ in pairs) > 300
    assert all(abs(plain_distance(a, b) / len(a) - c) < 1e-9 for a, b, c in pairs)


def test_candidates_are_ordered(spark):
    assert candidates(spark, SF_SMALL).groupBy("seq").count().filter("count > 1").count() == 0


def test_near_pairs_in_many_slices(spark, monkeypatch):
    """Each pair once, by no join, whatever the slices; rows without an id, a block, a vector or one of its numbers are left out."""
    import numpy as np

    from tessera.operators import dedup

    monkeypatch.setattr(dedup, "SLICE_ROWS", 7)
    monkeypatch.setattr(dedup, "PAIRS_AT_ONCE", 20)
    made = np.random.default_rng(5).normal(size=(120, 6)).astype(np.float32)
    rows = [(k, [float(x) for x in v], k % 2) for k, v in enumerate(made / np.linalg.norm(made, axis=1, keepdims=True))]
    rows += [(0, rows[1][1], 0), (500, rows[2][1][:5], 0), (501, None, 0), (502, [None, *rows[2][1][1:]], 0), (None, rows[2][1], 0), (503, rows[2][1], None)]
    found = dedup.near_pairs(spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int"), 0.35, "block")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    own = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]]
    dot = lambda a, b: sum((x * y for x, y in zip(a, b)), 0.0)
    want = sorted((a, b, dot(v, w)) for a, v, p in own for b, w, q in own if a < b and p == q and len(v) == len(w) and dot(v, w) >= 0.35)
    got = sorted((r.a, r.b, r.similarity) for r in found.collect())
    assert len(want) > 200 and [x[:2] for x in got] == [x[:2] for x in want]
    assert max(abs(x[2] - y[2]) for x, y in zip(got, want)) < 1e-12


def test_accept_tries_few_rows_of_a_cell(spark, monkeypatch):
    """The plain loop over cells that repeat themselves, with an earlier pool; a task gets the rows that decide, not the language."""
    import random

    import numpy as np

    from tessera.operators import dedup

    monkeypatch.setattr(dedup, "FIRST", 1)
    r, quota = random.Random(11), 5
    vectors = [[float(x) for x in v / np.linalg.norm(v)] for v in np.random.default_rng(2).normal(size=(40, 3)).astype(np.float32)]
    rows = []
    for seq in range(3000):
        few = r.random() < 0.8
        k = r.randrange(3 if few else 40)
        rows.append((seq, r.choice("ab"), f"c{r.randrange(4) if few else 4 + r.randrange(9)}", r.choice([f"k{k}", f"k{k}", None]), r.choice([None, None, "bad", ""]), None if k % 13 == 12 else vectors[k]))
    old = [("a", "c0", "k1", vectors[1]), *[("a", "c9", f"old{k}", None) for k in range(5)]]
    pools, want = {}, {}
    for seq, lang, cell, key, fault, v in [(None, *o[:3], None, o[3]) for o in old] + rows:
        keys, near, filled = pools.setdefault(lang, (set(), [], {}))
        if seq is not None:
            if filled.get(cell, 0) >= quota:
                continue
            if fault or key in keys or v and near and max(float(np.float32(v) @ np.float32(o)) for o in near) >= 0.95:
                want[seq] = fault or ("exact_duplicate" if key in keys else "near_duplicate")
                continue
            want[seq] = "accepted"
        keys.add(key)
        filled[cell] = filled.get(cell, 0) + 1
        near += [v] if v else []
    frame = spark.createDataFrame(rows, "seq long, language string, cell string, key string, fault string, vector array<float>")
    found = dedup.accept_in_order(frame, quota, 0.95, spark.createDataFrame(old, "language string, cell string, key string, vector array<float>"))
    assert {x.seq: x.outcome for x in found.collect()} == want
    assert set(want.values()) == {"accepted", "bad", "exact_duplicate", "near_duplicate"} and len(want) < len(rows)
    assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert dedup.accept_in_order(frame, 0, 0.95).count() == 0
