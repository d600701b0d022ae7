import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyline.llm import archives

KIND = "page_id LONG, url STRING, html STRING"
V1 = b"filedesc://a.arc 0.0.0.0 19980101000000 text/plain 76\n1 0 Org\nURL IP-address Archive-date Content-type Archive-length\nxxxxxxx\n"


def arc(version, *records):
    fields = archives.ARC_FIELDS[version]
    body = f"{version} 0 Org\n{' '.join(fields)}\n".encode()
    out = [f"filedesc://a.arc 0.0.0.0 19980101000000 text/plain {'- ' * (len(fields) - 5)}{len(body)}\n".encode() + body]
    for line, doc in records:
        out.append(f"{line} {len(doc)}\n".encode() + doc)
    return b"\n".join(out)


def test_header_lines_of_both_versions():
    doc = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n\nfiledesc: no"
    one = arc(1, ("http://a/ with space 1.2.3.4 19980203 text/html", doc), ("dns:a 0.0.0.0 199802030405 text/dns", b"x"))
    got = list(archives.arc_records(one))
    assert [f["URL"] for f, _ in got] == ["http://a/ with space", "dns:a"]
    assert got[0][1] == doc and got[1][1] == b"x"
    two = arc(2, ("http://a/ 1.2.3.4 19980203040506 text/html 200 - - 0 a.arc", doc))
    (fields, body), = archives.arc_records(two)
    assert (fields["Result-code"], fields["Filename"], body) == ("200", "a.arc", doc)
    assert list(archives.arc_records(b"")) == []


@pytest.mark.parametrize("data", [b"no description\n", arc(1, ("u 1 2 t", b"abc"))[:-1], arc(1, ("u 1", b"abc"))])
def test_broken_archives_say_so(data):
    with pytest.raises(ValueError):
        list(archives.arc_records(data))


def test_dates():
    assert archives.arc_date("19980203040506") == "1998-02-03T04:05:06Z"
    assert archives.arc_date("199802030405") == "1998-02-03T04:05:00Z"
    assert archives.arc_date("19980203") == "1998-02-03T00:00:00Z"
    assert archives.arc_date("1998") == "1998-01-01T00:00:00Z"


def pages(spark):
    rows = [(4, "http://a/", "same"), (2, "http://b/ x", "same"), (9, None, "é\r\n\r\nWARC/1.0"), (1, "", None), (3, "u", ""),
            (5, "u", "same"), (6, "u", "x" * 70_000), (None, "u", "lost id")]
    return rows, spark.createDataFrame(rows, KIND).withColumn("type", F.lit("clash")).repartition(3)


def test_round_trip(spark, folder):
    rows, frame = pages(spark)
    path = archives.convert_arc(spark, archives.write_arc(frame, f"{folder}/arc", file_bytes=100), f"{folder}/warc")
    got = archives.read_warc(spark, path).collect()
    assert len(got) == len(rows) and all(r.sound for r in got)
    ids = {r.page_id: r for r in got}
    for i, _, page in rows:
        data = (page or "").encode()
        assert ids[i].payload_bytes == len(data)
        assert ids[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {i: r.type for i, r in ids.items()} == {
        1: "response", 2: "response", 3: "revisit", 4: "revisit", 5: "revisit", 6: "response", 9: "response", None: "response"}
    assert ids[4].refers_to == ids[5].refers_to == ids[2].record_id and ids[3].refers_to == ids[1].record_id
    assert ids[2].uri == "http://b/x" and ids[9].uri == "unknown:"


def test_conversion_is_repeatable_and_small_payloads_may_stay(spark, folder):
    _, frame = pages(spark)
    arcs = archives.write_arc(frame, f"{folder}/arc")
    records = archives.read_arc(spark, arcs)
    assert sorted(r.record_id for r in records.collect()) == sorted(r.record_id for r in archives.read_arc(spark, arcs).collect())
    marked = archives.mark_revisits(records, least_bytes=5)
    assert marked.where("refers_to is not null").count() == 0


def test_plain_and_foreign_archives(spark, tmp_path):
    place = tmp_path / "arc"
    place.mkdir()
    data = arc(1, ("http://a/ 1.2.3.4 19980203040506 text/html", b"HTTP/1.0 200 OK\r\n\r\nhi"), ("dns:a 0.0.0.0 1998 text/dns", b"1.2.3.4"))
    (place / "a.arc").write_bytes(data)
    (place / "b.arc.gz").write_bytes(gzip.compress(data))
    got = archives.read_arc(spark, str(place)).collect()
    assert sorted((r.type, r.payload_bytes) for r in got) == [("resource", 7)] * 2 + [("response", 2)] * 2


def test_empty_table(spark, folder):
    frame = spark.createDataFrame([], KIND)
    path = archives.convert_arc(spark, archives.write_arc(frame, f"{folder}/arc"), f"{folder}/warc")
    assert archives.read_warc(spark, path).count() == 0
