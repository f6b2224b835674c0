import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from farelane.llm import queries
from farelane.llm import warc_bundles as wb


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/warc"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, record_id string, key int")


ROWS = [(3, "http://a/ b\r\nX: y", "same"), (1, "http://b", "same"), (2, None, "same"), (5, "http://c", None), (4, "http://d", ""),
        (6, "http://e", "WARC/1.1\r\n\r\nodd \0 héé 日本"), (7, "http://f", "x" * 3_000_000), (None, "http://g", "same"), (None, "http://h", "alone"),
        (8, "http://i", "twice"), (8, "http://i", "twice"), (-9, "http://j", "minus")]


def test_round_trip_of_awkward_rows(spark, folder):
    pages = pages_of(spark, ROWS)
    index = wb.write_bundles(wb.classify(pages), folder, frame_bytes=1000)
    got = wb.read_bundles(index, folder, with_payload=True)
    rows = got.withColumn("page_id", wb.row_key("record_id", "long")).withColumn("to", wb.row_key("refers_to", "long")).collect()
    assert len(rows) == len(ROWS)
    assert wb.broken_revisits(got).isEmpty()
    have = sorted(((r.page_id, r.record_type, r.to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in rows), key=repr)
    first = {}
    for i, _, html in ROWS:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        to = first.get(html or "")
        to = None if to == i else to
        want.append((i, "revisit" if to is not None else "response", to, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     None if to is not None else data))
    assert have == sorted(want, key=repr)


def test_bundles_are_plain_zstandard_streams_of_records(spark, folder, tmp_path):
    import zstandard
    pages = pages_of(spark, [(i, f"http://{i}", random.Random(i % 40).choice("abc") * (i % 40)) for i in range(300)])
    index = wb.write_bundles(wb.classify(pages, least_bytes=10), folder, frame_bytes=2000, bundle_bytes=500)
    files = list((tmp_path / "warc" / "bundles").iterdir())
    named = {r.bundle for r in index.select("bundle").distinct().collect()}
    assert {f.name for f in files} == named and len(files) > 8
    seen = 0
    for f in files:
        data = zstandard.ZstdDecompressor().stream_reader(f.open("rb"), read_across_frames=True).read()
        at = 0
        while at < len(data):
            headers, block, at = wb.parse(data, at)
            seen += headers["WARC-Type"] in ("response", "revisit")
            assert headers["WARC-Type"] != "revisit" or b"\r\nContent-Length: 0" not in block
    assert seen == 300 == index.count()


def test_one_record_is_read_from_its_frame_alone(spark, folder, monkeypatch):
    pages = pages_of(spark, [(i, f"http://{i}", f"page {i} " * 50) for i in range(200)])
    index = wb.write_bundles(wb.classify(pages), folder, frame_bytes=2000)
    got = wb.read_bundles(index.where("key = 77"), folder, with_payload=True).collect()
    assert [bytes(r.payload) for r in got] == [b"page 77 " * 50]
    one = index.where("key = 77").first()
    fs, root = wb.file_system(folder)
    reader = wb.BundleReader(fs.open_input_file(f"{root}/bundles/{one.bundle}"))
    assert len(reader.frames) > 5 and reader.frame(one.frame)[one.offset:one.offset + one.length].startswith(b"WARC/1.1")


def test_damage_is_noticed(spark, folder, tmp_path):
    wb.write_bundles(wb.classify(pages_of(spark, [(1, "u", "payload")])), folder)
    file = next((tmp_path / "warc" / "bundles").iterdir())
    file.write_bytes(file.read_bytes()[:-3])
    fs, _ = wb.file_system(folder)
    with pytest.raises(ValueError):
        wb.BundleReader(fs.open_input_file(str(file)))


def test_small_payloads_and_heavy_groups(spark):
    rows = [(i, "u", "hot" if i % 3 == 0 else f"own {i // 2}") for i in range(3000)] + [(9000, "u", "ab"), (9001, "u", "ab")]
    got = {r.key: r.refers_to for r in wb.classify(pages_of(spark, rows), least_bytes=3).select("key", "refers_to").collect()}
    first = {}
    for i, _, html in rows:
        first.setdefault(html, i)
    assert got == {i: (None if first[h] == i or len(h) < 3 else first[h]) for i, _, h in rows}


def test_empty_table(spark, folder):
    index = wb.write_bundles(wb.classify(pages_of(spark, ROWS).where("false")), folder)
    assert index.count() == 0 and wb.read_bundles(index, folder).count() == 0


def test_string_ids(spark, folder):
    pages = spark.createDataFrame([("a:b -é+", "u", "x"), ("-", "u", "x"), ("", "u", "y")], "page_id string, url string, html string")
    got = wb.read_bundles(wb.write_bundles(wb.classify(pages), folder), folder)
    rows = got.select(wb.row_key("record_id", "string").alias("i"), wb.row_key("refers_to", "string").alias("t")).collect()
    assert sorted((r.i, r.t or "") for r in rows) == [("", ""), ("-", ""), ("a:b -é+", "-")]


def test_query_matches_its_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS FROM '{sf}/pages.parquet'")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE['op12_warc_bundles']}) ORDER BY 1").fetchall()
    got = queries.op12_warc_bundles(spark, sf).select(*cols).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want and F is not None
