from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from llm.nasty import LONG

from lakestrata.llm.warc import page_records, read_warc, write_warc
from lakestrata.session import session_conf, work_dir

INNER = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nbody"
PAYLOADS = [
    (1, "http://a/1", "x" * 300),
    (2, "http://a/2", "x" * 300),
    (3, "http://a/3", "x" * 99),
    (4, "http://a/4", "x" * 99),
    (5, "http://a 5\r\nX: 1", None),
    (6, None, ""),
    (7, "http://a/7", "head" + INNER + INNER + "\r\n\r\nWARC/1.0\r\ntail"),
    (8, "http://a/8", INNER),
    (9, "http://a/9", "\r\n\r\n"),
    (10, "http://a/WARC/1.1", LONG),
    (11, "http://a/11", LONG),
    (12, "http://a/12", ("deep" + INNER) * 200),
    (2, "http://a/2", "x" * 300),
    (None, "http://a/none", "y" * 500),
    (None, "http://a/none", "y" * 500),
    (14, "http://a/14", "é \r\n" * 100),
]


def pages(spark, rows=PAYLOADS):
    table = [(i, url, html, f"clash{n}") for n, (i, url, html) in enumerate(rows)]
    return spark.createDataFrame(table, "page_id long, url string, html string, digest string").repartition(2)


def expected(rows=PAYLOADS):
    firsts = {}
    for i, _, html in rows:
        firsts.setdefault(html or "", []).append(i)
    out, seen = [], set()
    for i, _, html in rows:
        raw = (html or "").encode()
        keep = min((x for x in firsts[html or ""] if x is not None), default=None)
        again = len(raw) >= 100 and (i != keep or (html, i) in seen)
        seen.add((html, i))
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", keep if again else None))
    return Counter(out)


def found(pages_read):
    return Counter(
        tuple(r) for r in pages_read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    )


@pytest.mark.parametrize("split", ["1k", "4k", "128m"])
def test_round_trip(spark, split):
    path = work_dir(spark, "warc")
    write_warc(pages(spark), path)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1k"}):
        read = page_records(read_warc(spark, path))
        assert found(read) == expected()
        texts = {r["page_id"]: bytes(r["payload"]).decode() for r in read.filter("record_type = 'response'").collect()}
        assert texts[7] == PAYLOADS[6][2] and texts[12] == PAYLOADS[11][2] and texts[10] == LONG


def test_offsets_lead_from_record_to_record(spark):
    path = work_dir(spark, "warc")
    write_warc(pages(spark).coalesce(1), path)
    files = {}
    for row in read_warc(spark, path).collect():
        files.setdefault(row["file"], []).append((row["offset"], len("WARC/1.") + len(row["head"].encode()) + len(row["payload"]) + 4))
    for records in files.values():
        records.sort()
        assert records[0][0] == 0
        for (at, size), (after, _) in zip(records, records[1:], strict=False):
            assert at + size == after


def test_broken_length_ends_a_file(spark):
    path = work_dir(spark, "warc")
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\nabcd"
    lines = [(record.format(4),), (record.format(9),), (record.format(4),)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert [bytes(r["payload"]) for r in read_warc(spark, path).orderBy("offset").collect()][:1] == [b"abcd"]
    assert read_warc(spark, path).count() == 2


def chain(raw):
    """(offset, payload) of the records that the chain from the start of a file reaches."""
    boundary, out, at = b"\r\n\r\nWARC/1.", [], 0
    if not raw.startswith(b"WARC/1."):
        return out
    while True:
        after = raw.find(boundary, at + 1)
        piece = raw[at : after if after >= 0 else len(raw)]
        head = piece.find(b"\r\n\r\n")
        length = re.search(rb"\r\nContent-Length: (\d+)\r\n", piece[: head + 2]) if head >= 0 else None
        if not length:
            return out
        start = at + head + 4
        end = start + int(length[1])
        if raw[end : end + len(boundary)] == boundary:
            out.append((at, raw[start:end]))
            at = end + 4
            continue
        whole = end == len(raw) or raw[end:] == b"\r\n\r\n"
        out.append((at, raw[start:end] if whole else raw[start : min(end, after if after >= 0 else len(raw))]))
        return out


LENGTHS = ["2", "9", "40", "100000", "-4", "four", None]


@pytest.mark.parametrize("split", ["256b", "128m"])
def test_broken_lengths_end_the_chain(spark, split):
    """Short, long, missing and negative lengths at the first, a middle and the last record."""
    path, files = work_dir(spark, "warc"), {}
    for where in (0, 2, 4):
        for n, length in enumerate(LENGTHS):
            records = []
            for i in range(5):
                body = f"ab{i}d" + (INNER if i in (1, 3) else "")
                stated = f"Content-Length: {length}\r\n" if i == where else f"Content-Length: {len(body)}\r\n"
                stated = "" if i == where and length is None else stated
                records.append(f"WARC/1.1\r\nWARC-Type: response\r\n{stated}\r\n{body}")
            one = f"{path}/{where}-{n}"
            spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(one)
            files[f"{where}-{n}"] = ("\r\n\r\n".join(records) + "\r\n\r\n").encode()
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}):
        rows = read_warc(spark, f"{path}/*").collect()
    got = {}
    for row in rows:
        got.setdefault(row["file"].rsplit("/", 2)[1], []).append((row["offset"], bytes(row["payload"])))
    expected_rows = {name: chain(raw) for name, raw in files.items()}
    assert {name: sorted(found) for name, found in got.items()} == {n: e for n, e in expected_rows.items() if e}


def test_ids_that_are_no_numbers_are_kept_as_text(spark):
    path = work_dir(spark, "warc")
    rows = [("a-1", "u", "x"), ("7", "u", "y")]
    write_warc(spark.createDataFrame(rows, "page_id string, url string, html string"), path)
    got = {(r["page_key"], r["page_id"]) for r in page_records(read_warc(spark, path)).collect()}
    assert got == {("a-1", None), ("7", 7)}


def test_file_that_opens_with_no_record(spark):
    path = work_dir(spark, "warc")
    spark.createDataFrame([("junk" + INNER,)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    assert read_warc(spark, path).count() == 0


def test_empty_table(spark):
    path = work_dir(spark, "warc")
    write_warc(pages(spark).limit(0), path)
    assert read_warc(spark, path).count() == 0
