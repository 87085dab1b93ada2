import gzip
import hashlib
import os

from hourwise.llm import warc

PAGE = "<html><head><title>t</title></head><body><nav>Menu</nav><p>A &amp; b\n c</p><script>x</script><p>é</p></body></html>"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_derivatives_link_and_keep_digests(spark):
    rows = warc.derived_from_pages(pages(spark, [(1, "http://x/", PAGE)])).collect()
    r = warc.response_of(1, "http://x/", PAGE.encode())
    by = {x.record_type: x for x in rows}
    assert set(by) == {"metadata", "conversion"} and len({x.record_id for x in rows}) == 2
    assert all(x.refers_to == r["record_id"] and x.target_uri == "http://x/" for x in rows)
    assert by["conversion"].concurrent_to == by["metadata"].record_id
    assert bytes(by["conversion"].block).decode() == "Menu\nA & b c\né"
    payload = "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
    fields = dict(line.split(": ", 1) for line in bytes(by["metadata"].block).decode().splitlines())
    assert fields["source-payload-digest"] == payload == by["conversion"].source_digest
    assert fields["source-record-id"] == r["record_id"] and fields["source-header-content-type"] == "text/html; charset=utf-8"
    assert fields["source-block-digest"] == "sha256:" + hashlib.sha256(r["block"]).hexdigest()
    assert all(x.block_digest == "sha256:" + hashlib.sha256(bytes(x.block)).hexdigest() and x.content_length == len(x.block) for x in rows)


def test_whole_visible_text():
    page = "<html><head><title>t</title><body>a<svg class=i/><select><option>b<option>c</select><textarea>d <b></textarea><object>e</object>"
    assert warc.plain_text(page + "<math><mi>x</mi></math><p>f<video>g</video>") == "a\nb\ncd <b>ex\nf"


def test_nulls_repeats_long_and_empty(spark):
    long = "<p>word</p>" * 200_000
    rows = warc.derived_from_pages(pages(spark, [(None, None, None), (2, "u", ""), (2, "u", ""), (3, "u", long)])).collect()
    assert len(rows) == 8 and len({x.record_id for x in rows}) == 6
    assert [bytes(x.block) for x in rows if x.record_type == "conversion" and x.page_id != 3] == [b""] * 3
    assert next(x for x in rows if x.page_id == 3 and x.record_type == "conversion").content_length == 5 * 200_000 - 1
    assert warc.derived_from_pages(pages(spark, [])).collect() == []


def test_http_bodies(spark):
    def one(headers, body):
        block = ("HTTP/1.1 200 OK\r\n" + "\r\n".join(headers) + "\r\n\r\n").encode() + body
        return warc.derivatives({"record_id": "<r>", "target_uri": "", "date": "d", "block": block})
    zipped = gzip.compress("<p>ü</p>".encode("latin-1"))
    chunked = b"%x\r\n" % len(zipped) + zipped + b"\r\n0\r\n\r\n"
    head = ["Content-Type: text/html; charset=ISO-8859-1", "Content-Encoding: gzip", "Transfer-Encoding: chunked"]
    assert one(head, chunked)[1]["block"].decode() == "ü"
    assert [x["record_type"] for x in one(["Content-Type: image/png"], b"\x89PNG")] == ["metadata"]
    assert one(["Content-Type: text/plain"], b"a <b>")[1]["block"] == b"a <b>"
    assert len(one([], b"")) == 2 and len(warc.derivatives({"record_id": "r", "target_uri": "", "date": "", "block": b"junk"})) == 2


def test_round_trip_through_files(spark, tmp_path):
    records = warc.derived_from_pages(pages(spark, [(i, f"http://x/{i}", PAGE * (i + 1)) for i in range(20)] + [(99, None, None)]))
    members = [bytes(x.member) for x in warc.serialised(records).collect()]
    (tmp_path / "a b.warc.gz").write_bytes(b"".join(members[:30]))
    (tmp_path / "c.warc").write_bytes(b"".join(map(gzip.decompress, members[30:])))
    names = ["record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type", "content_length", "block_digest", "block"]
    got = sorted(map(tuple, warc.read(spark, os.fspath(tmp_path)).select(*names).collect()), key=repr)
    assert got == sorted(map(tuple, records.select(*names).collect()), key=repr)


def test_responses_with_nulls(spark):
    r = spark.createDataFrame([("<a>", None, None, None)], "record_id string, target_uri string, date string, block binary")
    assert {x.record_type for x in warc.derived(r).collect()} == {"metadata", "conversion"}


def test_damaged_files_give_errors_and_all_that_can_be_read(spark, tmp_path):
    records = [warc.to_bytes({"record_type": "response", "record_id": f"<r{i}>", "target_uri": "u", "date": "d", "content_type": "t",
                              "block": b"x" * (100 + i)}) for i in range(6)]
    zipped = [gzip.compress(r, mtime=0) for r in records]
    bad = bytearray(zipped[2])
    bad[30] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(b"".join([*zipped[:2], bytes(bad), zipped[3], b"rubbish", zipped[4], zipped[5][:-20]]))
    lines = [records[0], records[1].replace(b"Content-Length: 101", b"Content-Length: many"), records[2],
             records[3].replace(b"Content-Length: 103\r\n", b""), records[4].replace(b"Content-Length: 104", b"Content-Length: 99999"),
             records[5], b"WARC/1.1\r\nWARC-Type: cut"]
    (tmp_path / "b.warc").write_bytes(b"".join(lines))
    (tmp_path / "c.warc").write_bytes(b"no record at all")
    (tmp_path / "d.warc.gz").write_bytes(b"")
    got = sorted((x.record_id, len(x.block)) for x in warc.read(spark, os.fspath(tmp_path)).collect())
    assert got == sorted([(f"<r{i}>", 100 + i) for i in (0, 1, 3, 4)] + [(f"<r{i}>", 100 + i) for i in (0, 2, 5)])
    bad = [(x.path.rsplit("/", 1)[1], x.error) for x in warc.errors(spark, os.fspath(tmp_path)).collect()]
    assert sorted(bad) == sorted(
        [("a.warc.gz", "damaged or cut gzip member")] * 2 + [("a.warc.gz", "no gzip member"), ("b.warc", "Content-Length 'many'"),
         ("b.warc", "Content-Length ''"), ("b.warc", "record cut short"), ("b.warc", "header without an end"), ("c.warc", "no record")])


def test_reading_is_linear_in_the_file():
    import time
    record = {"record_type": "response", "record_id": "<r>", "target_uri": "u", "date": "d", "content_type": "t", "block": os.urandom(20_000)}
    one = gzip.compress(warc.to_bytes(record), mtime=0)

    def took(n):
        t = time.process_time()
        assert sum(1 for _ in warc.from_bytes(one * n)) == n
        return time.process_time() - t
    took(50)
    assert took(2000) < 10 * max(0.05, took(400))


def test_page_ids_keep_their_type_and_other_columns_are_not_read(spark):
    rows = spark.createDataFrame([("a", "u", PAGE), ("b", None, None)], "page_id string, url string, html string").selectExpr("*", "1 as block", "2 as date")
    got = warc.derived_from_pages(rows)
    assert dict(got.dtypes)["page_id"] == "string" and sorted({x.page_id for x in got.collect()}) == ["a", "b"]
