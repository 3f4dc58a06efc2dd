"""Operators 1, 3, 4 and 5 against the libraries, row by row."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import chunked_bpe, packing, queries, token_counts, tokenfile
from tessera.llm.bpe import encoder
from tests.conftest import SF_SMALL

BYTE, WORD, PIECE = queries.BYTE_BPE, queries.WORD_BPE, queries.PIECE_BPE


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def library(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t.'aAbsStré'ÉÅ<|>1²ΣŒ\x85\x1c "), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_memoised_ids_equal_the_library(path, text):
    lib = encoder(path)
    assert lib.encode(text) == lib.encode_whole(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["the cat", "a  b\n", "<|endoftext|>", "日本", "x" * 300, " and so on it goes. " * 40, "été "]), max_size=14))
def test_chunks_join_exactly(parts):
    text = "".join(parts)
    lib = encoder(BYTE)
    assert chunked_bpe.chunked_encoder(BYTE).encode(text) == lib.encode_whole(text)
    borders = chunked_bpe.chunk_borders(text.encode())
    assert not text or borders[-1] == len(text.encode())


@pytest.fixture(scope="module", params=["odd", "small"])
def folder(request, odd_dir):
    return odd_dir if request.param == "odd" else SF_SMALL


def texts_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").toPandas()


def test_op1(spark, folder):
    docs, encode = texts_of(spark, folder), library(BYTE)
    out = queries.op1_best_fit_packing(spark, folder).toPandas()
    want = []
    for d, t in zip(docs.doc_id, docs.text):
        ids = [*encode(t or ""), 0]
        want += [(d, n, s, length, crc(ids[s : s + length])) for n, (s, length) in enumerate(packing.cut(len(ids), 2048))]
    key = lambda r: tuple(-1 if x != x else int(x) for x in r)
    got = [key(r) for r in out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(got) == sorted(map(key, want))
    total = 0
    for _, bin_ in out.sort_values("offset").groupby("sequence_id"):
        assert (bin_.offset.values == np.cumsum([0, *bin_.length[:-1]])).all() and bin_.length.sum() <= 2048
        total += 1
    assert total == plain_best_fit(out.length.tolist(), 2048)


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit_plan(histogram, 50)
    rooms: dict = {}
    for length in sorted(histogram, reverse=True):
        rows = plan[plan[:, 0] == length]
        for rank in range(histogram[length]):
            row = rows[np.searchsorted(rows[:, 1], rank, side="right") - 1]
            nth, at = divmod(rank - row[1], row[3])
            used = rooms.get(row[2] + nth, 0)
            open_rooms = [50 - u for u in rooms.values() if 50 - u >= length]
            assert used == row[4] + at * length and used + length <= 50
            assert min(open_rooms, default=50) == 50 - used
            rooms[row[2] + nth] = used + length
    assert len(rooms) == plain_best_fit(lengths, 50)


def test_op3(spark, folder):
    docs, encode = texts_of(spark, folder), library(WORD)
    out = queries.op3_token_files(spark, folder).toPandas().sort_values("start")
    want = {(None if d != d else int(d), crc(ids), len(ids)) for d, t in zip(docs.doc_id, docs.text) for ids in [[*encode(t or ""), 1]]}
    assert {(None if d != d else int(d), c, n) for d, c, n in zip(out.doc_id, out.ids_crc32, out.n_tokens)} == want and len(out) == len(docs)
    assert (out.start.values == np.cumsum([0, *out.n_tokens[:-1]])).all()
    known = out.doc_id.dropna()
    assert known.is_monotonic_increasing


def test_token_file_reads_only_what_is_asked(tmp_path):
    path = str(tmp_path / "x.tok")
    docs = {d: np.arange(d, d + n, dtype="<u4").tobytes() for d, n in ((3, 10), (4, 200_000), (9, 0), (11, 70_000), (12, 5))}
    with open(path, "wb") as out:
        writer = tokenfile.ShardWriter(out)
        for d, ids in docs.items():
            writer.add(d, ids)
        writer.close()
    fs, root = tokenfile.open_folder(str(tmp_path))
    reader = tokenfile.ShardReader(fs.open_input_file(path))
    assert reader.ids(4) == docs[12] and reader.decompressed == 1
    assert [reader.ids(i) for i in range(5)] == list(docs.values()) and reader.doc_ids == list(docs)
    raw = bytearray(open(path, "rb").read())
    raw[reader.frames[1].offset + 100] ^= 1
    open(path, "wb").write(raw)
    broken = tokenfile.ShardReader(fs.open_input_file(path))
    assert broken.ids(0) == docs[3]
    with pytest.raises(Exception):
        broken.ids(1)


def test_read_wanted(spark, odd_dir):
    manifest = tokenfile.write_token_files(spark.read.parquet(f"{odd_dir}/documents.parquet"), WORD, 1)
    rows = {r.doc_id: r for r in tokenfile.read_token_files(manifest).collect()}
    some = tokenfile.read_token_files(manifest, wanted=[5, 19]).collect()
    assert {r.doc_id for r in some} == {5, 19} and len(some) == 4
    assert all(bytes(r.ids) == bytes(rows[r.doc_id].ids) for r in some)


def test_op4(spark, folder):
    from tokenizers import Tokenizer

    docs, tok = texts_of(spark, folder), Tokenizer.from_file(BYTE)
    out = queries.op4_chunked_bpe(spark, folder).toPandas()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in zip(docs.doc_id, docs.text):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((-1 if d != d else int(d), len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    got = [(-1 if r[0] != r[0] else int(r[0]), *r[1:]) for r in out[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]].itertuples(index=False)]
    assert sorted(got) == sorted(want)


def test_op5(spark, folder):
    import sentencepiece

    docs, lib = texts_of(spark, folder), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    out = queries.op5_token_counts(spark, folder).toPandas()
    want = [(-1 if d != d else int(d), len((t or "").encode()), n := len(lib.encode(t or "")), n > 4096) for d, t in zip(docs.doc_id, docs.text)]
    got = [(-1 if r[0] != r[0] else int(r[0]), *r[1:]) for r in out[["doc_id", "n_bytes", "n_tokens", "over_limit"]].itertuples(index=False)]
    assert sorted(got) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabcdeé▁<s>/日1", max_size=30), max_size=8))
def test_counts_equal_the_library(texts):
    counter = token_counts.counter(PIECE)
    assert counter.splits
    assert counter.count(texts) == [len(x) for x in counter.library.encode(texts)]


SPACED = st.lists(st.sampled_from([" ", "  ", "   ", "▁", "\n", "\t", "a", "the", "ing", "日", "本", "é", "<s>", "0", "x" * 30, ".", "\u3000", "ﬁ", "\x00"]), max_size=16)


@settings(max_examples=300, deadline=None)
@given(text=SPACED.map("".join))
def test_runs_of_spaces_are_split(text):
    counter = token_counts.counter(PIECE)
    assert counter.count([text]) == [len(counter.library.encode(text))]


@settings(max_examples=200, deadline=None)
@given(text=st.lists(SPACED.map("".join), min_size=4, max_size=12).map("".join))
def test_long_parts_and_slices(text):
    """As for texts of millions of characters, with smaller limits."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "LONG", 20)
        patch.setattr(token_counts, "SLICE", 50)
        counter = token_counts.counter(PIECE)
        assert counter.count([text]) == [len(counter.library.encode(text))]


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=100, deadline=None)
@given(text=st.lists(st.sampled_from(["the cat", " ", "  ", "\n", "日本", "é́", "<|endoftext|>", "x" * 40, ". "]), max_size=30).map("".join))
def test_long_texts_are_encoded_in_slices(path, text):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("tessera.llm.bpe.SLICE", 16)
        patch.setattr(chunked_bpe, "BLOCK", 64)
        lib = encoder(path)
        assert lib.encode(text) == lib.encode_whole(text)
        if path == BYTE:
            assert chunked_bpe.ChunkedEncoder(BYTE).encode(text) == lib.encode_whole(text)


def test_chunk_borders_do_not_depend_on_blocks(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    whole = chunked_bpe.chunk_borders(data)
    monkeypatch.setattr(chunked_bpe, "BLOCK", 777)
    assert chunked_bpe.chunk_borders(data) == whole and len(whole) > 50


def test_memo_is_bounded_by_bytes():
    from tessera.llm.bpe import Memo

    made = []
    memo = Memo(lambda k: made.append(k) or k.upper(), budget=50_000, longest=100)
    for i in range(5000):
        assert memo[f"k{i}"] == f"K{i}"
    assert memo.held < 51_000 and len(memo) + len(memo.old) < 600 and memo["k4999"] == "K4999" and made.count("k4999") == 1
    assert memo["x" * 101] == "X" * 101 and "x" * 101 not in memo


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_of_letters_are_held_once(path):
    from tessera.llm.bpe import LibraryEncoder

    lib = LibraryEncoder(path, 1 << 20)
    text = "so quixo, (quixo) quixo été's Quixo- quixo"
    assert lib.encode(text) == lib.encode_whole(text)
    assert "quixo" in lib.words and (" quixo" if path == BYTE else "quixo") not in lib.parts
    for i in range(0, 60_000, 100):
        lib.encode(" ".join(f"w{j}x, v{j}" for j in range(i, i + 100)))
    assert lib.words.held + lib.parts.held < 1.2 * (1 << 20) and lib.parts.budget * 8 <= lib.words.budget


def test_plain_parts_skip_the_byte_table():
    from tessera.llm.bpe import LibraryEncoder

    lib = LibraryEncoder(BYTE, 1 << 20)
    text = "plain words, then été and \x7f or \x01"
    want, lib.table = lib.encode_whole(text), {}
    assert lib.encode("plain words, then") == lib.encode_whole("plain words, then")
    lib = LibraryEncoder(BYTE, 1 << 20)
    assert lib.encode(text) == want


def test_letters_that_grow_when_lowered():
    """Lower-casing these gives letters beyond the Latin patterns."""
    for text in ("a ȺB ȾȾx y", "İx Ⱥ1"):
        assert encoder(WORD).encode(text) == encoder(WORD).encode_whole(text)


def test_texts_of_megabytes(spark):
    """A long text without spaces, one of white space and one of words, counted and encoded whole."""
    texts = ["日本語" * 70_000, " \n" * 300_000, "some words, and more. " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PIECE).collect()}
    lib = token_counts.counter(PIECE).library
    assert counted == {i: (len(t.encode()), len(lib.encode(t))) for i, t in enumerate(texts)}
    ids = {r.doc_id: len(r.ids) for r in chunked_bpe.encode_documents(docs, BYTE).collect()}
    assert ids == {i: len(library(BYTE)(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["op1_best_fit_packing", "op3_token_files", "op4_chunked_bpe", "op5_token_counts"])
def test_empty(spark, empty_dir, name):
    assert getattr(queries, name)(spark, empty_dir).count() == 0
