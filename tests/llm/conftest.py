import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

ODD_TEXTS = [
    None, "", " ", "  a", " a b ", "a\n\nb", "a \n b", "x<|endoftext|> y  z", "<|startoftext|>hi", "İstanbul É é́ don't we'll 123 45.6",
    "tab\tx \x1c y\x1d", "ends \n", "日本語テキスト です。 日本", "a b\xa0c", "ΑΣ ΣΑΣ", "👍🏽 ok", "\r\n x\r\ny", "▁ a▁b  c", "0 1 2", "same text here", "same text here",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing extra columns."""
    rnd = random.Random(5)
    alphabet = " \n\t.,'\"abcXYZéß日́ 1234 \x85\x1c"
    texts = ODD_TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    texts += [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta's", "x-1"]) for _ in range(30000)), "z" * 5000]
    rows = [(i, t, ["en", None, "de"][i % 3], "s", 7, "clash", 3) for i, t in enumerate(texts)]
    rows += [rows[19], rows[19], (None, "no id", "en", None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long, component_id string, length int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def odd_dir(odd_docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    odd_docs.coalesce(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    text, num = pa.string(), pa.int64()
    tables = {
        "documents": {"doc_id": num, "text": text, "lang": text, "source": text, "n_chars": num},
        "pages": {"page_id": num, "url": text, "html": text},
        "labels": {"doc_id": num, "quality": pa.int32(), "toxic": pa.int32()},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table({c: pa.array([], k) for c, k in columns.items()}), folder / f"{name}.parquet")
    return str(folder)
