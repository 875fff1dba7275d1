import hashlib
import random
import time

import pytest
import zstandard

from framewright.llm import warc
from framewright.llm.warc import ArchiveWriter, WarcError, archive_round_trip, parse_record, read_archive, render, train_dictionary


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' body", "'clash' digest", "'clash' first")


def test_round_trip_with_revisits(spark):
    long = "<p>é</p>" * 200_000
    rows = [(1, "http://a/\r\nb c", "same"), (2, None, "same"), (3, "x", None), (4, "y", ""), (5, "z", long), (None, "n", "same"), (6, "q", "once"), (6, "q", "once")]
    got = archive_round_trip(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, r)
        assert r.payload is None or hashlib.sha1(r.payload).digest() == warc.base64.b32decode(r.payload_digest)
    assert [(by[i].record_type, by[i].refers_to) for i in (1, 2, None)] == [("revisit", 2), ("response", None), ("revisit", 2)]
    assert [(by[i].record_type, by[i].refers_to, by[i].payload_bytes) for i in (3, 4)] == [("revisit", 4, 0), ("response", None, 0)]
    assert by[5].payload.decode() == long and by[1].payload_bytes == 4 and by[1].payload_digest == by[2].payload_digest
    assert [r.record_type for r in got if r.page_id == 6] == ["response", "response"]
    assert archive_round_trip(pages(spark, rows).limit(0)).count() == 0


def archive(records):
    writer = ArchiveWriter(train_dictionary([b"<html><body>text</body></html>" * 20] * 30))
    for r in records:
        writer.add(r)
    return writer.out.getvalue()


RECORD = render("urn:page:1", "response", "http://a", b"payload", None)


def test_one_frame_a_record_and_a_leading_dictionary():
    data = archive([RECORD, render("urn:page:2", "revisit", "http://b", b"payload", "urn:page:1")])
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    got = list(read_archive(data))
    assert [r["type"] for r in got] == ["response", "revisit"] and got[0]["payload"] == b"payload" and got[1]["payload_bytes"] == 7
    plain = zstandard.ZstdCompressor().compress(RECORD)
    assert [r["payload"] for r in read_archive(plain + plain)] == [b"payload", b"payload"]  # no dictionary


@pytest.mark.parametrize(("old", "new"), [
    (b"WARC/1.1", b"WARC/9.9"), (b"payload\r\n\r\n", b"payloa\r\n\r\n"), (b"payload\r\n\r\n", b"payloaX\r\n\r\n"), (b"WARC-Date", b"WARC-Dat"),
    (b"WARC-Record-ID", b"WARC-Type"), (b"Content-Length: 7", b"Content-Length: 8"), (b"HTTP/1.1", b"GOPH/1.1"), (b"\r\n\r\n", b"\n"), (b"response\r\n", b"revisit\r\n"),
])
def test_broken_records_are_refused(old, new):
    assert old in RECORD
    with pytest.raises(WarcError):
        parse_record(RECORD.replace(old, new))


def test_broken_archives_are_refused():
    data = archive([RECORD])
    for broken in (data[:-3], data[:40], data[:-1] + b"x", data + b"junk"):
        with pytest.raises(WarcError):
            list(read_archive(broken))


def test_reading_takes_time_in_proportion():
    """Eight times the frames take about eight times as long; a reader that copies the rest for each takes 64 times."""
    record = render("urn:page:1", "response", "http://a", random.Random(1).randbytes(1500), None)
    writer = ArchiveWriter(b"WARC/1.1")
    seconds = []
    for frames in (2_700, 21_600):  # some 4 and 32 MiB
        while len(writer) < frames * 1500:
            writer.add(record)
        began = time.perf_counter()
        assert sum(1 for _ in read_archive(writer.out.getvalue())) > frames // 2
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 20 * max(seconds[0], 0.01)


def test_a_hot_payload(spark):
    rows = [(i, f"http://a/{i}", "<p>gone</p>" if i % 3 else f"<p>{i}</p>") for i in range(4000)]
    got = {r.page_id: r for r in archive_round_trip(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all((got[i].record_type, got[i].refers_to) == (("revisit", 3998) if i % 3 and i != 3998 else ("response", None)) for i in got)
    assert all(r.payload_bytes == len(rows[i][2]) and (r.payload is None) == (r.record_type == "revisit") for i, r in got.items())


def test_other_skippable_frames_are_passed_over():
    note = (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"notes"
    data = archive([RECORD])
    assert len(list(read_archive(data + note + data[len(archive([])) :]))) == 2
