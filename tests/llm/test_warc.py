import base64
import gzip
import hashlib

import pytest

from docspark.llm import warc


def test_url_keys():
    assert warc.url_key("http://www.Example.org:80/A/b?Q=1#top") == "org,example)/a/b?q=1"
    assert warc.url_key("https://m.x.net:8443") == "net,x,m:8443)/"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert warc.url_key("not a\turl") == "not%20a%09url"
    assert warc.url_key("http://[bad") == "http://[bad"


def test_record_round_trip():
    body = b"a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    raw = warc.record(4, "http://a\n.b/c", body, warc.digest32(body), None, False)
    r = warc.parse(raw)
    assert r["body"] == body and r["WARC-Type"] == "response" and r["WARC-Target-URI"] == "http://a.b/c"
    r = warc.parse(warc.record(4, None, body, warc.digest32(body), 9, True))
    assert r["body"] == b"" and r["WARC-Refers-To"] == "<urn:page:9>" and r["WARC-Payload-Length"] == str(len(body))


def brute(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for html, ids in groups.items():
        keep, used = max((i for i in ids if i is not None), default=None), False
        for i in ids:
            response = i == keep and not used
            used |= response
            digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
            out.append((i, len(html.encode()), digest, "response" if response else "revisit", None if response else keep))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("lines,segments", [(4, 3), (1024, 16384)])
def test_pages_equal_brute_force(spark, lines, segments):
    rows = [(i, f"http://h{i % 3}.org/{i % 11}", f"<p>{i % 17}é</p>") for i in range(300)]
    rows += [(1000 + i, "http://hot.org/", "hot") for i in range(200)] + [(7, "http://h.org", "hot"), (7, "http://h.org", "hot")]
    rows += [(2000, None, None), (2001, "x y", ""), (2002, "http://z.org", "z" * 400_000), (1199, "http://hot.org/", "hot"), (2**60 + 1, "u", "u")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string").repartition(4)
    index = warc.archive(df, lines=lines, segments=segments)
    got = warc.fetch(index, df).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    one = warc.fetch(index, df.where("page_id IN (1000, 1001)"))
    assert {r.page_id for r in one.collect()} == {1000, 1001}
    assert {bytes(r.body) for r in one.where("record_type = 'response'").collect()} <= {b"hot"}


def test_null_page_id_and_empty(spark):
    df = spark.createDataFrame([(None, "http://a.org", "q"), (None, "http://a.org", "q")], "page_id long, url string, html string")
    got = sorted(r.record_type for r in warc.fetch(warc.archive(df), df).collect())
    assert got == ["response", "revisit"]
    assert warc.fetch(warc.archive(df.limit(0)), df).count() == 0


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx"), (3, "a", "yyyy"), (4, "a", "yyyy")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.fetch(warc.archive(df, min_bytes=3), df).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_are_plain_gzip(spark):
    from pyarrow import fs

    df = spark.createDataFrame([(1, "http://a.org", "one"), (2, "http://b.org", "two")], "page_id long, url string, html string")
    index = warc.archive(df)
    store, root = warc._open_fs(index.folder)
    text = b""
    for f in store.get_file_info(fs.FileSelector(root)):
        if f.path.endswith(".warc.gz"):
            text += gzip.decompress(store.open_input_file(f.path).readall())
    assert text.count(b"WARC/1.1") == 2 and b"one" in text


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    got = entry.queries()["op2_warc_index"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in pages])
