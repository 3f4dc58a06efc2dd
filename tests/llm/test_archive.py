"""The archive of operator 8 where scans are planned anew."""

import pytest

from tessera.llm import warc


def test_rows_numbered_otherwise_in_a_second_plan(spark, tmp_path, monkeypatch):
    """File splits change between the plans, as when an executor joins or is lost."""
    rows = [(i, f"u{i}", f"text {i % 7}") for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages")
    key, write = "spark.sql.files.minPartitionNum", warc.persist_table

    def and_then_pack(df, label):
        out = write(df, label)
        spark.conf.set(key, "1")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return out

    monkeypatch.setattr(warc, "persist_table", and_then_pack)
    try:
        archive = warc.write_archive(spark.read.parquet(f"{tmp_path}/pages"))
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    back = {r.page_id: (bytes(r.payload), r.record_type, r.refers_to) for r in warc.read_archive(spark, archive, payloads=True).collect()}
    assert back == {i: (t.encode(), "response" if i < 7 else "revisit", None if i < 7 else i % 7) for i, _, t in rows}


def test_missing_payloads_raise(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "one"), (2, "v", "two")], "page_id long, url string, html string")
    archive = warc.write_archive(pages, folder=f"{tmp_path}/archive")
    records, payloads = warc.open_archive(spark, archive)
    payloads.filter("payload = CAST('one' AS BINARY)").write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(warc, "open_archive", lambda *_: (records, kept))
        for read in (warc.read_archive, warc.export_records):
            with pytest.raises(Exception, match="(?i)payload"):
                read(spark, archive).collect()
