"""Records and look-ups: round trips, repeated keys, shards and blocks of any size."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import warc
from gaugeline.llm.oracles import ORACLES
from gaugeline.llm.queries import QUERIES

LONG = "<html>" + "é" * 200


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "page_id long, url string, html string")

    return make


def read_all(spark, frame, shards=None):
    folder = warc.scratch_path(spark, "warc")
    entries = warc.write_archives(warc.with_revisits(frame), folder)
    index = warc.write_index(entries, folder, shards)
    keys = frame.select(warc.key_of(F.col("url"), F.col("page_id")).alias("key")).distinct()
    return warc.look_up(keys, index, folder), entries, index, folder


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        keeper = first.get(payload)
        refers = keeper if keeper is not None and keeper != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers, b"" if refers is not None else payload))
    return sorted(map(str, out))


def found(frame):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(str((*[r[n] for n in names], bytes(r.payload))) for r in frame.collect())


ROWS = [
    (3, "http://a.example.com/x?q=1", LONG), (1, "https://www.a.example.com/x", LONG), (2, "http://b.org/", "short"),
    (4, "http://b.org/", "short"), (5, None, None), (6, "not a url at all\r\nX: y", ""), (7, "http://[bad", LONG + "!"),
    (None, "http://c.net/", LONG), (8, "http://c.net/é ü", "x" * 99), (9, "http://c.net/", "x" * 100), (10, "u", "x" * 100),
    (2, "http://b.org/", "another"), (9, "http://c.net/", "x" * 100), (-5, "http://c.net/", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
]


@pytest.mark.parametrize("block", [1, 2, 1000])
@pytest.mark.parametrize("shards", [1, 3])
def test_round_trip(spark, pages, monkeypatch, block, shards):
    monkeypatch.setattr(warc, "BLOCK", block)
    got, entries, index, _ = read_all(spark, pages(*ROWS), shards)
    assert found(got) == expected(ROWS)
    assert entries.count() == len(ROWS) and 1 <= len(index) <= shards


def test_many_captures_of_one_url(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    rows = [(i % 40, "http://hot.com/", f"page {i}") for i in range(120)]
    got, *_ = read_all(spark, pages(*rows), 4)
    assert found(got) == expected(rows)


def test_files_are_plain_warc(spark, pages, tmp_path):
    rows = [(i, f"http://h{i}.com/", LONG + str(i)) for i in range(6)]
    _, entries, _, folder = read_all(spark, pages(*rows))
    files, root = warc.open_folder(folder)
    for e in entries.collect():
        with files.open_input_file(f"{root}/{e.file}") as f:
            record = warc.parse_record(zlib.decompress(f.read_at(e.size, e.start), 31))
            whole = f.read_at(f.size(), 0)
        assert record["payload"].decode() == LONG + str(e.page_id)
        assert record["warc"]["warc-target-uri"] == f"http://h{e.page_id}.com/"
        members = []
        while whole:
            unpack = zlib.decompressobj(31)
            members.append(unpack.decompress(whole))
            whole = unpack.unused_data
        assert b"WARC-Type: warcinfo" in members[0] and all(m.endswith(b"\r\n\r\n") for m in members)


def test_a_look_up_reads_few_blocks(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 5)
    rows = [(i, f"http://site{i:03d}.com/", f"text {i}") for i in range(100)]
    _, _, index, folder = read_all(spark, pages(*rows), 1)
    lookup = warc.Index(folder)
    read = []
    real = lookup._range
    lookup._range = lambda file, start, size: read.append(file) or real(file, start, size)
    key = warc.entry_key("http://site042.com/", 42).encode()
    [(page_id, file, start, size)] = lookup.entries(index[0]["file"], key)
    assert page_id == 42 and lookup.record(file, start, size)["payload"] == b"text 42"
    assert sum(f.endswith("cdx.gz") for f in read) <= 2
    assert list(lookup.entries(index[0]["file"], b"com,nowhere)/ 1")) == []


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/A?b=C#d", "com,example)/A?b=C"), ("https://a.b.example.co.uk:8080/", "uk,co,example,b,a:8080)/"),
        ("http://example.com:80", "com,example)/"), (None, "-"), ("", "-"), ("mailto:x", "mailto:x"), ("http://[bad", "http://[bad"),
        ("http://x.com/a b\n", "com,x)/a%20b%0A"),
    ],
)
def test_reversed_hosts(url, key):
    assert warc.reversed_host(url) == key


def test_keys_sort_by_id_within_a_url():
    ids = [None, -(1 << 62), -1, 0, 5, 40, 1 << 62]
    keys = [warc.entry_key("http://x.com/", i) for i in ids]
    assert keys == sorted(keys)


def test_damage_is_noticed(spark, pages):
    record = warc.parse_record(warc.make_record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None))
    with pytest.raises(ValueError, match="agree"):
        warc._row(record, True)
    with pytest.raises(ValueError, match="WARC"):
        warc.parse_record(b"HTTP/1.1 200 OK\r\n")


def test_no_pages(spark, pages):
    frame = pages(*ROWS).limit(0)
    _, shards, folder = warc.archive(spark, frame)
    assert shards == []
    keys = frame.select(warc.key_of(F.col("url"), F.col("page_id")).alias("key"))
    assert warc.look_up(keys, shards, folder).count() == 0


def test_extra_columns_are_left_out(spark, pages):
    frame = pages(*ROWS).withColumn("digest", F.lit(1)).withColumn("first", F.lit("x"))
    assert warc.with_revisits(frame).columns == ["page_id", "url", "payload", "digest", "refers_to"]


def test_the_query_and_its_sql(spark):
    import duckdb

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op10_warc"](spark, sf_dir).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = con.execute(ORACLES["op10_warc"])
    names = [d[0] for d in want.description]
    assert collections.Counter(tuple(r[n] for n in names) for r in got) == collections.Counter(want.fetchall())
