import gzip
import io

import pytest

from mailspark.llm import warc
from mailspark.llm.warc import (
    BrokenArchive,
    member,
    read_archives,
    read_records,
    record,
    round_trip,
    sha1_of,
    write_archives,
)
from tests.llm.helpers import EDGE, empty, table


def pages(spark, rows=EDGE):
    docs = table(spark, rows, text="html")
    return docs.withColumnRenamed("doc_id", "page_id").withColumnRenamed("source", "url")


def brute(rows):
    last = 1 << 63
    first = {}
    for i, t in rows:
        first[t or ""] = min(first.get(t or "", last), last if i is None else i)
    found = []
    for i, t in rows:
        own = (last if i is None else i) > first[t or ""]
        data = (t or "").encode()
        found.append((i, len(data), sha1_of(data), "revisit" if own else "response", first[t or ""] if own else None))
    return sorted(found, key=repr)


def got(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    assert got(round_trip(spark, pages(spark))) == brute(EDGE)


def test_empty_table(spark):
    assert round_trip(spark, pages(spark, []).limit(0)).collect() == []
    assert empty(spark).count() == 0


def test_payloads_come_back(spark, tmp_path):
    archives = write_archives(pages(spark).repartition(3), str(tmp_path / "a b"))
    rows = read_archives(archives, keep_payload=True).collect()
    kept = sorted(bytes(r.payload).decode() for r in rows if r.record_type == "response")
    expected = [r for r in brute(EDGE) if r[3] == "response"]
    assert len(kept) == len(expected)
    assert set(kept) == {t or "" for _, t in EDGE}
    assert archives.agg({"records": "sum"}).first()[0] == len(EDGE)


def test_addresses_keep_to_their_line(spark):
    rows = [(1, "http://a.example/x y\r\nWARC-Type: revisit", "é")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    row = round_trip(spark, docs).first()
    assert row.record_type == "response" and row.url.startswith("http://a.example/x%20y%0D%0A")


def archive():
    return b"".join(
        member(x)
        for x in (
            record(1, "http://a.example/", b"<p>one</p>" * 50_000),
            record(2, None, b"", None),
            record(3, "http://a.example/3", b"<p>one</p>" * 50_000, refers_to=1),
        )
    )


def test_any_gzip_reader_can_read_members():
    text = gzip.decompress(archive())
    assert text.count(b"WARC/1.1\r\n") == 3 and text.endswith(b"\r\n\r\n")


@pytest.mark.parametrize("chunk", [1, 7, 1000, 1 << 20])
def test_chunks_of_any_size(monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    found = list(read_records(io.BytesIO(archive()), keep_payload=True))
    assert [r.payload_bytes for r in found] == [500_000, 0, 500_000]
    assert [len(r.payload) for r in found] == [500_000, 0, 0]
    assert found[0].payload_digest == found[2].payload_digest


def broken():
    good = record(1, None, b"some payload")
    yield good.replace(b"some payload", b"same payload"), "digest"
    yield good.replace(b"Content-Length: 12\r\n\r\nsome", b"Content-Length: 13\r\n\r\nsome"), "digest"
    yield good[:-3], "shorter"
    yield good + b"x", "longer"
    yield b"HTTP" + good, "version"


@pytest.mark.parametrize("data, what", list(broken()))
def test_broken_records_are_refused(data, what):
    with pytest.raises(BrokenArchive):
        list(read_records(io.BytesIO(member(data))))


def test_cut_archives_are_refused():
    with pytest.raises(BrokenArchive):
        list(read_records(io.BytesIO(archive()[:-20])))


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://names:8020")
        assert warc._uri(spark, "/shared/x") == "hdfs://names:8020/shared/x"
        assert warc._uri(spark, "file:///a/b") == "file:///a/b"
        conf.set("fs.defaultFS", "file:///")
        assert warc._uri(spark, "/shared/x") == "file:///shared/x"
    finally:
        conf.set("fs.defaultFS", before)


def test_archives_at_a_path_without_a_scheme(spark, tmp_path):
    archives = write_archives(pages(spark), str(tmp_path / "plain"))
    assert got(read_archives(archives)) == brute(EDGE)
    assert all(r.path.startswith(f"file://{tmp_path}") for r in archives.collect())
