import base64
import hashlib

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import rows_of

from contrail.llm import warc

SCHEMA = "page_id long, url string, html string, bytes long, sha1 string, packed int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/", "<p>é</p>"), (2, "http://b/ x\r\nWARC-Type: evil", "<p>é</p>"), (3, None, None), (4, "u", ""),
    (5, "u", "x" * 200_000), (6, "u", "line\r\n\r\nline"), (7, "u", "<p>é</p>"), (7, "u", "<p>é</p>"), (8, "u", "ab"),
    (9, "u", "ab"), (None, "u", "ab"), (None, "u", "only null"), (10, "u", "z" * 9), (11, "u", "z" * 9),
]


def expected(rows, least):
    first = {}
    for i, _, html in rows:
        first[html or ""] = max((x for x in (first.get(html or ""), i) if x is not None), default=None)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= least and i != first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 3])
def test_records_read_back(spark, scratch, least):
    archive = warc.write_archive(pages(spark, ROWS), scratch, least)
    assert rows_of(warc.record_facts(spark, archive)) == expected(ROWS, least)
    stored = spark.read.parquet(archive.payloads)
    assert stored.count() == len({r[2] or "" for r in ROWS})


def test_whole_records_are_exact(spark, scratch):
    archive = warc.write_archive(pages(spark, ROWS), scratch)
    got = warc.read_records(spark, archive).collect()
    assert len(got) == len(ROWS)
    for r in got:
        fields, http, body = warc.parse_record(bytes(r.record))
        assert bytes(r.record).startswith(bytes(r.header))
        assert body == (b"" if fields["WARC-Type"] == "revisit" else bytes(r.payload))
        assert f"Content-Length: {len(r.payload)}\r\n".encode() in http
        assert b"\r\n" not in fields.get("WARC-Target-URI", "").encode()
    assert sum(b"evil" in bytes(r.header) for r in got) == 1


def test_records_have_names_of_their_own(spark, scratch):
    rows = ROWS + [(7, "u", "another payload"), (7, "v", "<p>é</p>"), (12, "w", "<p>é</p>"), (12, "x", "<p>é</p>"), (12, "w", "<p>é</p>")]
    archive = warc.write_archive(pages(spark, rows), scratch)
    assert rows_of(warc.record_facts(spark, archive)) == expected(rows, 0)
    got = [(warc.parse_record(bytes(r.record))[0], bytes(r.payload)) for r in warc.read_records(spark, archive).collect()]
    named = {fields["WARC-Record-ID"]: (fields, payload) for fields, payload in got}
    assert len(named) == len(rows)
    for fields, payload in got:
        if fields["WARC-Type"] == "revisit":
            response, same = named[fields["WARC-Refers-To"]]
            assert response["WARC-Type"] == "response" and same == payload


def test_copies_are_stored_once_and_a_broken_store_is_noticed(spark, scratch):
    rows = [(k, "u", "the same") for k in range(2000)] + [(5000, "u", "other")]
    archive = warc.write_archive(pages(spark, rows), scratch)
    assert spark.read.parquet(archive.payloads).count() == 2
    assert rows_of(warc.record_facts(spark, archive)) == expected(rows, 0)
    swapped = spark.read.parquet(archive.payloads).withColumn("sha256", F.unhex(F.sha2("sha256", 256)))
    swapped.write.parquet(f"{scratch}/broken")
    heads = spark.read.parquet(archive.headers).withColumn("sha256", F.unhex(F.sha2("sha256", 256)))
    heads.write.parquet(f"{scratch}/heads")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.record_facts(spark, warc.Archive(f"{scratch}/broken", f"{scratch}/heads")).collect()


def test_empty_table(spark, scratch):
    archive = warc.write_archive(pages(spark, []), scratch)
    assert warc.record_facts(spark, archive).collect() == []
