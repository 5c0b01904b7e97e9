"""WARC archives: members, index and revisits against plain reading."""

import base64
import glob
import gzip
import hashlib
import io
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from mercato.llm import catalog, warc


def pages():
    rng = random.Random(3)
    rows = [(i, f"http://h{i}.example/ä b?{i}", rng.choice(["", "<p>same</p>", "x" * 70_000, f"<p>{i} \r\n\r\n WARC/1.1</p>", "é€😀", None]), "z", 7)
            for i in range(200)]
    rows += [(None, None, "<p>same</p>", None, None), (None, None, "only null id", None, None), (5, "u\r\nWARC-Type: x", "twice", "", 0),
             (5, "u", "twice", "", 0), (900, "u", "y" * 3_000_000, "", 0)]
    return rows


SCHEMA = "page_id long, url string, html string, digest string, record int"


def local(uri):
    return re.sub("^file:/+", "/", uri)


def expected(rows, least=0):
    by = {}
    for pid, _, html, *_ in rows:
        by.setdefault(html or "", []).append(pid)
    out = []
    for html, ids in by.items():
        raw = html.encode()
        ids.sort(key=lambda x: (x is not None, x or 0))
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for i, pid in enumerate(ids):
            kept = i == len(ids) - 1 or len(raw) < least
            out.append((pid, len(raw), digest, "response" if kept else "revisit", None if kept else ids[-1]))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    archives = warc.archive(df, min_bytes=least)
    read = warc.read_archives(archives)
    assert found(read) == expected(rows, least)
    payloads = {bytes(r["payload"]) for r in read.where("record_type = 'response'").collect()}
    assert payloads == {(r[2] or "").encode() for r in rows}
    assert read.where("record_type = 'revisit' and payload is not null").count() == 0
    assert {r["records"] for r in archives.collect()} != {0}


def test_files(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    folder = f"file://{tmp_path}/warc"
    listing = warc.write_monolithic(df, f"{folder}/crawl", archive_bytes=100_000)
    streams = glob.glob(f"{tmp_path}/warc/crawl/*.warc.gz")
    assert len(streams) > 2  # archives close at their size
    for f in streams:  # each is one member: nothing follows its end
        one = zlib.decompressobj(31)
        one.decompress(open(f, "rb").read())
        assert one.eof and not one.unused_data
    archives = warc.normalise(warc.revisits(listing), f"{folder}/members")
    for a in archives.collect():
        raw = open(local(a["archive"]), "rb").read()
        lines = open(local(a["index"])).read().splitlines()
        assert len(lines) == a["records"] and len(raw) == a["bytes"]
        whole = b""
        for line in lines:
            offset, length, rid, kind, digest = line.split(" ")
            member = zlib.decompressobj(31)
            record = member.decompress(raw[int(offset):int(offset) + int(length)])
            assert member.eof and not member.unused_data  # one member a record
            head = record[:record.index(b"\r\n\r\n")].decode()
            assert f"WARC-Record-ID: {rid}" in head and f"WARC-Type: {kind}" in head and f"WARC-Payload-Digest: {digest}" in head
            assert ("WARC-Refers-To: <urn:uuid:" in head) == (kind == "revisit")
            whole += record
        assert gzip.decompress(raw) == whole  # and the file as a whole is still a gzip file
    ids = [line.split(" ")[2] for a in archives.collect() for line in open(local(a["index"])).read().splitlines()]
    assert len(ids) == len(set(ids)) == len(rows)


def test_revisits_name_a_record_that_is_there(spark):
    archives = warc.archive(spark.createDataFrame(pages(), SCHEMA).repartition(4))
    heads = []
    for a in archives.collect():
        raw = open(local(a["archive"]), "rb").read()
        heads += [fields for fields, _ in warc.records(warc._Stream(io.BytesIO(raw)))]
    stored = {h["WARC-Record-ID"]: h["WARC-Payload-Digest"] for h in heads if h["WARC-Type"] == "response"}
    for h in heads:
        if h["WARC-Type"] == "revisit":
            # ids are kept by the rewriting, so the reference still holds
            assert stored[h["WARC-Refers-To"]] == h["WARC-Payload-Digest"]


def test_damaged_member_is_not_read(spark):
    archives = warc.archive(spark.createDataFrame([(1, "u", "text " * 50)], "page_id long, url string, html string"))
    path = local(archives.first()["archive"])
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="zlib|digest|incorrect|invalid"):
        warc.read_archives(archives).collect()


def test_hot_payload_and_cold_ones(spark, monkeypatch):
    rows = [(i, "u", "hot" if i % 3 == 0 else f"c{i // 4}") for i in range(600)]
    monkeypatch.setattr(warc, "HOT_SHARE", 10)
    got = found(warc.read_archives(warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string"))))
    assert got == expected(rows)


def test_other_id_types_and_empty_table(spark):
    rows = [("a+b %20", "u", "x"), ("ü", "u", "x"), ("", "u", "y")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = found(warc.read_archives(warc.archive(df), T.StringType()))
    assert [(r[0], r[3], r[4]) for r in got] == [("", "response", None), ("a+b %20", "revisit", "ü"), ("ü", "response", None)]
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.read_archives(warc.archive(empty)).collect() == []


def test_query_columns(spark):
    from conftest import SF001

    df = catalog.queries()["op11_warc_normaliser"](spark, SF001)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(df) == expected(rows)
