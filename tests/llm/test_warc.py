import base64
import glob
import gzip
import hashlib

from pyspark.sql import functions as F

from sensorspark.llm import warc


def sha(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def read_files(path):
    """A plain reader: headers to the blank line, then as many bytes as they say."""
    for name in glob.glob(f"{path}/*.gz"):
        data = gzip.open(name).read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            first, *lines = data[at:end].decode().split("\r\n")
            assert first == "WARC/1.1"
            head = dict(line.split(": ", 1) for line in lines)
            block = data[end + 4: end + 4 + int(head["Content-Length"])]
            at = end + 4 + len(block)
            assert data[at: at + 4] == b"\r\n\r\n"
            at += 4
            yield head, block.decode()


def test_pages_table_round_trip(spark, folder, tmp_path):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    source = {r.record_id: r for r in warc.responses(pages).collect()}
    derived = warc.derive(warc.responses(pages))
    rows = derived.collect()
    assert len(rows) == 2 * pages.count() and len({r.record_id for r in rows}) == len(rows)
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        of = source[r.refers_to]
        assert r.source_digest == of.payload_digest == sha(of.payload) and r.target_uri == of.target_uri
        assert r.block_digest == sha(r.block) and r.content_length == len(r.block.encode())
        other = by_id[r.concurrent_to]
        assert other.concurrent_to == r.record_id and {r.warc_type, other.warc_type} == {"metadata", "conversion"}
        if r.warc_type == "metadata":
            assert f"source-payload-digest: {of.payload_digest}\r\n" in r.block and f"conversion: {other.record_id}\r\n" in r.block
            assert all(f"source-header: {h}\r\n" in r.block for h in of.http_headers.split("\r\n") if h)
        else:
            assert "<p>" not in r.block and "track(" not in r.block
    path = str(tmp_path / "out")
    warc.write(derived, path)
    stored = {h["WARC-Record-ID"]: (h, b) for h, b in read_files(path)}
    assert stored.keys() == by_id.keys()
    for i, (head, block) in stored.items():
        assert block == by_id[i].block and head["WARC-Refers-To"] == by_id[i].refers_to and head["WARC-Block-Digest"] == sha(block)


def test_reading_of_markup():
    html = ("<!DOCTYPE html><html lang=fr><head><title>A &amp; B</title><style>p{}</style></head><body><!-- no --><p>One&nbsp;two<br>three "
            "<b>four</b></p><script>var x='<p>hid</p>';</script><ul><li><a href='/u?a=1&amp;b=2'>link</a></ul>&lt;tail&gt;")
    text, title, lang, links = warc.read_page(html)
    assert text == "One two\nthree four\nlink\n<tail>" and (title, lang, links) == ("A & B", "fr", ["/u?a=1&b=2"])
    assert warc.read_page("") == ("", "", None, []) and warc.read_page("a < b & c <unclosed")[0].startswith("a < b & c")
    assert len(warc.read_page("<div>" * 20000 + "x" + "<" * 2000)[0]) >= 1


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "http://a\r\nEvil: 1", "<p>é</p>", None), (2, "u", "", "x"), (2, "u", "", "x")],
                               "page_id long, url string, html string, block string")
    rows = warc.derive(warc.responses(df)).collect()
    assert len(rows) == 8 and all(r.content_length == len(r.block.encode()) for r in rows)
    assert [r.block for r in rows if r.page_id is None and r.warc_type == "conversion"] == ["é"]
    heads = [r.value for r in warc.record_text(warc.derive(warc.responses(df))).collect()]
    assert not any("\nEvil" in h for h in heads) and sum("WARC-Target-URI" in h for h in heads) == 6
    assert warc.derive(warc.responses(df.filter(F.lit(False)))).count() == 0
