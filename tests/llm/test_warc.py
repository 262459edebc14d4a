"""WARC: whole records round-trip through monolithic and per-record gzip; index, revisits and defined cases."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zlib
from pathlib import Path

from shoplens.llm import warc

SCHEMA = "page_id long, url string, html string"


def _expected(pages, min_payload=100):
    first = {}
    for page_id, _, html in sorted(pages, key=lambda p: p[0]):
        data = (html or "").encode()
        if len(data) >= min_payload:
            first.setdefault(data, page_id)
    out = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        ref = first.get(data, page_id)
        out[page_id] = (len(data), hashlib.sha256(data).hexdigest(), "response" if ref == page_id else "revisit", None if ref == page_id else ref)
    return out


def _pages():
    big = "<p>" + "é日本\r\n\r\nWARC/1.1\r\n" * 40
    pages = [(1, "http://a/\r\nx", None), (2, None, ""), (3, "u", "short"), (4, "u", "short"), (9, "u", big), (7, "u", big), (8, "u", big + "!"), (12, "u", big), (20, "u", "z" * 100), (21, "u", "z" * 100), (22, "u", "y" * 99), (23, "u", "y" * 99)]
    return pages + [(100 + i, f"u{i}", f"<html>{i % 7}</html>" * 20) for i in range(60)] + [(500, "long", "q" * 3_000_000)]


def test_pages_come_back(spark, tmp_path):
    df = spark.createDataFrame(_pages(), SCHEMA).selectExpr("*", "'x' as archive", "1 as ordinal").repartition(4)
    rows = warc.archive_pages(df, f"file://{tmp_path}").collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == _expected(_pages())
    assert len(rows) == len(_pages())
    whole, cut = sorted(Path(tmp_path, "monolithic").glob("*.gz")), sorted(Path(tmp_path, "records").glob("*.gz"))
    assert [p.name for p in whole] == [p.name for p in cut] and not list(Path(tmp_path).rglob("*.tmp"))
    for a, b in zip(whole, cut):
        data = a.read_bytes()
        machine = zlib.decompressobj(31)
        machine.decompress(data)
        assert machine.eof and not machine.unused_data  # one member
        index = [json.loads(x) for x in Path(f"{b}.index.jsonl").read_text().splitlines()]
        data, at = b.read_bytes(), 0
        for entry in index:  # members are gapless, each one whole record
            assert entry["offset"] == at
            (record,) = warc.records(iter([gzip.decompress(data[at : at + entry["length"]])]))
            assert record.headers["WARC-Record-ID"] == entry["id"]
            at += entry["length"]
        assert at == len(data) and len(index) == len(list(warc.records(warc.inflate(io.BytesIO(a.read_bytes())))))


def test_streaming_reader_over_tiny_chunks():
    recs = [warc.response(i, "u", b"\r\n\r\n" * i + b"x" * i) for i in range(50)]
    data = b"".join(r.encoded() for r in recs)
    for size in (1, 3, 7, 4096):
        assert list(warc.records(iter([data[i : i + size] for i in range(0, len(data), size)]))) == recs


def test_null_ids_repeats_and_empty(spark, tmp_path):
    big = "x" * 200
    df = spark.createDataFrame([(None, "u", big), (5, "u", big), (5, "u", big), (6, None, None)], SCHEMA)
    rows = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(df).collect()), key=str)
    assert rows == sorted([(None, "response", None), (5, "response", None), (5, "revisit", 5), (6, "response", None)], key=str)
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_damaged_archive_is_refused():
    data = warc.response(1, "u", b"abc").encoded()
    for bad in (data[:-3], data[:20], b"junk" + data):
        try:
            list(warc.records(iter([bad])))
        except ValueError:
            continue
        raise AssertionError("accepted")


def test_a_task_for_each_archive(spark, tmp_path):
    """Normalising is spread over as many tasks as there are archives, whatever their names hash to."""
    pages = spark.range(320).selectExpr("id as page_id", "'u' as url", "repeat('x', cast(id as int)) as html").repartition(16)
    rows = warc.archive_pages(pages, f"file://{tmp_path}")
    assert rows.count() == 320
    names = spark.createDataFrame([(f"/a/{i:06d}.warc.gz", None) for i in range(16)], "archive string, changes array<struct<ordinal: long, refers_to: long>>")
    per_task = names.repartitionByRange(16, "archive").rdd.glom().map(len).collect()
    assert per_task == [1] * 16
