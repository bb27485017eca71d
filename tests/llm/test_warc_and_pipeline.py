"""Archives: an exact round trip; the pipeline's stages on odd rows."""

import base64
import hashlib
import struct
import uuid

import pytest

from starload.llm import stages, warc
from starload.session import checkpoint_dir


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def folder(spark):
    return f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"


PAGES = [(i, f"http://a.example/{i}", f"<p>page {i} " + "some words of every page " * (i % 40)) for i in range(400)] + [
    (500, None, None), (501, "http://x/ y\r\nWARC-Type: evil", ""), (502, "", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n"), (503, "u", "é" * 300000), (504, "u", "é" * 300000),
    (None, "u", "<p>page 3 " + "some words of every page " * 3), (None, "u", "only without an id"), (None, "u", "only without an id"), (7, "again", "<p>page 7 " + "some words of every page " * 7),
]


@pytest.mark.parametrize("least", [0, 200])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS id", "'x' AS payload", "'y' AS sha").repartition(3)
    archives = warc.write_archives(pages, folder(spark), min_revisit_bytes=least)
    got = warc.read_archives(spark, archives).collect()
    first = {}
    for i, _, html in PAGES:
        p = (html or "").encode()
        if i is not None and len(p) >= least:
            first[p] = min(first.get(p, i), i)
    want = []
    for i, _, html in PAGES:
        p = (html or "").encode()
        revisit = first.get(p) is not None and first[p] != i
        want.append((i, len(p), sha(p), "revisit" if revisit else "response", first[p] if revisit else None, None if revisit else p))
    key = lambda r: tuple(str(x) for x in r[:5])
    have = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    assert archives.agg({"records": "sum"}).first()[0] == len(PAGES)


def test_archive_starts_with_its_dictionary(spark, tmp_path):
    import zstandard

    archive = warc.Archive(tmp_path.as_uri())
    raw = [warc.record(i, "http://x/", (f"<p>{i} " + "common words in all pages " * (5 + i % 9)).encode(), None, False, "2020-01-01T00:00:00Z") for i in range(3000)]
    for r in raw:
        archive.add(r)
    uri, n, size, dict_bytes = archive.close()
    data = open(uri.removeprefix("file://"), "rb").read()
    magic, length = struct.unpack("<II", data[:8])
    assert (magic, length, n, size) == (warc.DICT_MAGIC, dict_bytes, 3000, len(data)) and dict_bytes > 0
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + length])).decompressobj().decompress(data[8 + length :])
    assert one == raw[0] and list(warc.records_of(uri)) == raw


def test_truncated_archive(spark, tmp_path):
    archive = warc.Archive(tmp_path.as_uri())
    archive.add(warc.record(1, "u", b"x" * 1000, None, False, "d"))
    path = archive.close()[0].removeprefix("file://")
    with open(path, "r+b") as f:
        f.truncate(60)
    with pytest.raises((ValueError, __import__("zstandard").ZstdError)):
        list(warc.records_of(f"file://{path}"))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_archives(pages, folder(spark))
    assert archives.count() == 0 and warc.read_archives(spark, archives).count() == 0


def test_stages(spark, edge_docs, edge_rows, no_docs, tmp_path):
    texts = dict(edge_rows)
    sf = tmp_path.as_uri()
    spark.createDataFrame([(1, " ".join(texts[50].split()[3:20]))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    steps = dict(stages.STAGES)
    known = steps["language"](spark, edge_docs, sf)
    left = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in known.collect())
    assert known.columns == edge_docs.columns and {i for _, i, _ in left}.isdisjoint({1, 2, 3}) and {10, 20, 40, 120} <= {i for _, i, _ in left}
    single = steps["near_copies"](spark, edge_docs, sf)
    ids = [r.doc_id for r in single.collect()]
    assert {10, 20, 21, 22, 40, None} <= set(ids) and {11, 12, 13}.isdisjoint(ids) and ids.count(60) == 1 and ids.count(50) == 2
    cut = steps["passages"](spark, single, sf)
    rows = {r.doc_id: r for r in cut.collect()}
    shared = texts[22].split("\n")[1]
    assert {2, 3}.isdisjoint(rows) and rows[1].text is None  # nothing was left of the empty ones
    assert rows[20].text == texts[20] and shared not in rows[21].text and shared not in rows[22].text
    assert rows[22].text.split() == texts[22].replace(shared, "").split() and rows[22].n_chars == len(rows[22].text)
    clean = steps["decontaminated"](spark, cut, sf)
    assert [r.doc_id for r in clean.collect()].count(50) == 1 and clean.columns == edge_docs.columns
    assert set(r.doc_id for r in clean.collect()) == set(rows)
    assert {r.doc_id for r in steps["packed"](spark, clean, sf).collect()} == set(rows)
    for name, stage in stages.STAGES:
        assert stage(spark, no_docs, sf).count() == 0, name


def test_stages_leave_other_columns_alone(spark, tmp_path):
    from pyspark.sql import functions as F

    names = ["row_id", "ROW_TEXT", "told_lang", "span_id", "Span_List", "_id", "_kid", "_th", "_found", "_spans", "component", "spans"]
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"word{i} and some other words of text {i} the end " * 3 + (passage if i < 2 else ""), "en", "s") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    docs = docs.withColumns({n: F.lit(7) for n in names})
    sf = tmp_path.as_uri()
    spark.createDataFrame([(1, "nothing of the kind here")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in stages.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns, name
        assert got.count() > 0 and all(r[n] == 7 for r in got.collect() for n in names), name


def test_pipeline_runs_over_the_whole_table(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert docs * 0.8 < out.select("doc_id").distinct().count() <= docs
