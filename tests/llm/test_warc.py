import hashlib
import io
import os
import struct

import pytest
import zstandard
from tests.llm.conftest import brief

from veriframe.llm import warc as W
from veriframe.session import scratch


def archive(records):
    class Kept(io.BytesIO):
        def close(self):
            pass

    out = Kept()
    writer = W.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    writer.close()
    return out.getvalue()


def response(i, payload, **changed):
    row = {"page_id": i, "url": f"http://a/{i}", "record_type": "response", "payload": payload, "payload_bytes": len(payload),
           "payload_digest": hashlib.sha1(payload).hexdigest(), "refers_to": None} | changed
    return W.row_record(**row)


def read(data):
    return [W.record_row(h, b) for h, b in W.read_records(io.BytesIO(data), "t")]


def test_frames_and_dictionary():
    payloads = [b"", b"x", *(f"<html>{i} common words in every page</html>".encode() * 40 for i in range(2_000))]
    data = archive([response(i, p) for i, p in enumerate(payloads)])
    magic, size = struct.unpack("<II", data[:8])
    assert magic == W.DICTIONARY_MAGIC and size > 0
    got = read(data)
    assert [(r[0], r[3]) for r in got] == [(i, p) for i, p in enumerate(payloads)]
    # One frame per record: every frame alone decodes to one whole record.
    assert len(list(W.read_frames(io.BytesIO(data), chunk=7))) == len(payloads)
    # An uncompressed dictionary is read as well.
    trained = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    plain = struct.pack("<II", magic, len(trained)) + trained + data[8 + size :]
    assert read(plain) == got


def test_few_records_have_an_empty_dictionary():
    data = archive([response(1, b"abc")])
    assert struct.unpack("<II", data[:8]) == (W.DICTIONARY_MAGIC, 0)
    assert read(data)[0][3] == b"abc" and read(archive([])) == []


@pytest.mark.parametrize("fault", ["empty", "magic", "dictionary", "cut", "flip", "length", "digest", "header", "type", "version", "twice"])
def test_faults_are_found(fault):
    good = [response(i, b"payload %d" % i * 100) for i in range(5)]
    data = archive(good)
    if fault == "empty":
        data = b"123"
    elif fault == "magic":
        data = data[8:]
    elif fault == "dictionary":
        data = struct.pack("<II", W.DICTIONARY_MAGIC, 10**6) + data[8:]
    elif fault == "cut":
        data = data[:-3]
    elif fault == "flip":
        data = data[:-20] + bytes([data[-20] ^ 255]) + data[-19:]
    else:
        changed = {
            "length": good[0].replace(b"Content-Length: 900", b"Content-Length: 899"),
            "digest": good[0].replace(b"payload 0", b"payload 9", 1),
            "header": good[0].replace(b"WARC-Date: ", b"WARC-Date "),
            "type": good[0].replace(b"WARC-Type", b"WARC-Kind"),
            "twice": good[0].replace(b"Content-Length: 900", b"Content-Length: 900\r\ncontent-length: 900"),
            "version": good[0].replace(b"WARC/1.1", b"HTTP/1.1"),
        }[fault]
        assert changed != good[0]
        data = archive([good[1], changed])
    with pytest.raises(W.BadArchive):
        read(data)


def test_headers_cannot_be_injected():
    with pytest.raises(ValueError):
        W.record([("A", "x\r\nB: y")], b"")
    row = read(archive([response(3, b"x", url=" a\r\nB: ü\\x20 ")]))[0]
    assert row[1] == " a\r\nB: ü\\x20 "


def want(rows):
    out = []
    by = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 1000 and i is not None:
            by.setdefault(p, []).append(i)
    counts = {}
    for _, _, html in rows:
        counts[(html or "").encode()] = counts.get((html or "").encode(), 0) + 1
    for i, _, html in rows:
        p = (html or "").encode()
        keeper = max(by[p]) if p in by and counts[p] > 1 else None
        revisit = keeper is not None and i != keeper
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_round_trip(spark):
    big, edge, below = "b" * 5_000, "é" * 500, "s" * 999
    rows = [(1, "u", big), (7, None, big), (3, "u", big), (4, "u", edge), (5, "u", edge), (6, "u", below), (8, "u", below), (9, "u", None),
            (10, "u", ""), (None, "u", big), (None, "u", "n" * 2_000), (None, "u", "n" * 2_000), (11, "u", "r" * 3_000), (11, "u", "r" * 3_000),
            (12, "line\r\nend", "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as payload", "1 as _n", "'y' as record_type")
    assert brief(W.round_trip(df.repartition(3))) == want(rows)
    assert brief(W.round_trip(df.limit(0))) == []


def test_lost_attempts_are_not_read(spark):
    path = scratch(spark, "warc-test")
    df = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    W.write(W.with_revisits(df), path)
    with open(os.path.join(path.removeprefix("file:"), "part-dead.open"), "wb") as f:
        f.write(b"half an archive")
    assert W.read(spark, path).count() == 1
    assert W.read(spark, path + "-missing").count() == 0
