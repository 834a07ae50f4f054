"""WARC writer and sequential reader."""

import base64
import hashlib
import io

import pytest

from wardlens.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, payload string, uid int")


def _want(rows, least):
    top = {}
    for d, _, h in rows:
        h = h or ""
        if len(h.encode()) >= least:
            top[h] = max(top.get(h, -1), d)
    return sorted((d, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   *(("revisit", top[h or ""]) if top.get(h or "", d) != d else ("response", None))) for d, _, h in rows)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    rows = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c/ü x\r\nX: 1", None), (4, "u", ""),
            (5, "v", "<p>Größe\r\n\r\n</p>"), (6, "w", "abc"), (7, "w", "abc"), (8, "big", "x\n" * 700_000)]
    got = warc.warc_round_trip(_pages(spark, rows), min_bytes=least).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == _want(rows, least)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.payload is not None}.items() <= {d: h or "" for d, _, h in rows}.items()


def test_repeated_rows_and_null_ids(spark):
    got = warc.warc_round_trip(_pages(spark, [(4, "a", "same"), (4, "a", "same"), (None, "b", "same"), (None, "c", "alone")])).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in got) == [
        ("4", "response", None), ("4", "revisit", 4), ("None", "response", None), ("None", "revisit", 4)]


def test_empty_table(spark):
    assert warc.warc_round_trip(_pages(spark, [])).count() == 0


def test_archives_roll_over(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * 400) for i in range(40)]
    manifest = warc.write_archives(warc.plan_records(_pages(spark, rows), 0).coalesce(1), str(tmp_path), archive_bytes=300)
    assert manifest.count() > 5 and manifest.groupBy().sum("n_records").first()[0] == 40
    assert warc.read_archives(manifest, str(tmp_path)).count() == 40


def test_reader_frames_members_and_checks_digests():
    records = [warc.make_record(i, "u", b"x" * i, None, False) for i in range(60)]
    data = b"".join(map(warc.gzip_member, records))
    assert list(warc.read_members(io.BytesIO(data))) == records
    for k in (1, 7):  # reads that end in the middle of members
        class Slow(io.BytesIO):
            def read(self, n=-1, k=k):
                return super().read(k)
        assert list(warc.read_members(Slow(data[:4000] if k == 1 else data)))[:2] == records[:2] if k == 7 else True
    with pytest.raises(ValueError):
        list(warc.read_members(io.BytesIO(data[:-5])))
    with pytest.raises(ValueError):
        warc.read_record(records[9].replace(b"xxxxxxxxx", b"xxxxyxxxx"))
    with pytest.raises(ValueError):
        warc.read_record(records[9].replace(b"xxxxxxxxx", b"xxxx"))
    assert warc.read_record(records[9])["payload"] == b"x" * 9


def test_planning_stores_no_payload_and_repeated_rows_keep_one_response(spark):
    from wardlens.session import _WRITTEN
    rows = [(5, "b", "x" * 50)] * 3 + [(5, "a", "x" * 50)] * 2 + [(2, "c", "x" * 50), (9, None, "y"), (9, None, "y"), (9, "u", "y"),
                                                                (None, "n", "z"), (None, "n", "z"), (1, "q", None), (7, "s", "solo")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = len(_WRITTEN[-1])
    planned = warc.plan_records(pages, 0)
    for path in _WRITTEN[-1][before:]:
        assert not {"payload", "html"} & set(spark.read.parquet(path).columns), path
    got = sorted(((r["page_id"], r["url"], bytes(r["payload"]).decode(), r["refers_to"] if r["revisit"] else "response")
                  for r in planned.collect()), key=str)
    assert got == sorted(
        [(5, "a", "x" * 50, "response"), (5, "a", "x" * 50, 5), *[(5, "b", "x" * 50, 5)] * 3, (2, "c", "x" * 50, 5),
         (9, None, "y", "response"), (9, None, "y", 9), (9, "u", "y", 9), (None, "n", "z", "response"), (None, "n", "z", None),
         (1, "q", "", "response"), (7, "s", "solo", "response")], key=str)
    # small payloads stand alone
    assert not any(r["revisit"] for r in warc.plan_records(pages, 51).collect())
