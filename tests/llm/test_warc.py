import gzip
import hashlib

import pytest

from tidemill.llm import warc

SCHEMA = "page_id BIGINT, url STRING, html STRING, uri STRING, digest STRING"


def expected(pages):
    """By the contract, in plain Python."""
    found = []
    for page_id, html in pages:
        payload = (html or "").encode()
        ids = [i for i, h in pages if (h or "").encode() == payload and i is not None]
        first = min(ids, default=None) if len(payload) >= 100 else None
        again = first is not None and page_id != first and len([1 for _, h in pages if (h or "").encode() == payload]) > 1
        found.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(found, key=repr)


LONG = "<p>é\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n</p>\n" * 60
PAGES = [
    (5, "x" * 100), (3, "x" * 100), (9, "x" * 100), (7, "y" * 99), (8, "y" * 99), (1, None), (2, ""), (4, LONG), (6, LONG + "\r\n\r\n"),
    (None, "x" * 100), (10, LONG), (4, LONG), (-11, "z\r\n" * 4000), (12, "\n"), (13, "w" * 200),
]


def test_round_trip_by_the_contract(spark, rows_of):
    pages = spark.createDataFrame([(i, "http://a/\r\nWARC/1.0" if i else None, h, "u", "d") for i, h in PAGES], SCHEMA).repartition(3)
    got = warc.pages_through_warc(pages)
    assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected(PAGES)


def test_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", h, "u", "d") for i, h in PAGES], SCHEMA).coalesce(1)
    warc.write_monolithic(warc.page_records(pages), f"{tmp_path}/mono")
    index = warc.normalise(spark, f"{tmp_path}/mono", f"{tmp_path}/out")
    rows = index.collect()
    assert len(rows) == len(PAGES)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "mono").glob("*.gz"))
    for archive in {r["archive"] for r in rows}:
        with open(archive, "rb") as file:
            data = file.read()
        for r in (r for r in rows if r["archive"] == archive):
            record = gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
            assert record == whole[r["source_offset"] : r["source_offset"] + len(record)]
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(index).where("record_type = 'response'").collect()}
    assert payloads[4] == LONG.encode() and payloads[1] == b""


def test_no_pages(spark):
    assert warc.pages_through_warc(spark.createDataFrame([], SCHEMA)).count() == 0


def test_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.warc.gz", "wb") as file:
        file.write(b"WARC/1.0\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="ends inside a record"):
        warc.normalise(spark, f"{tmp_path}/in", f"{tmp_path}/out")
