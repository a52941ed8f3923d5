import hashlib

import pytest
from pyspark.sql import functions as F

from stormfare.llm import warc

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\n"
        "Content-Length: 3\r\n\r\nabc\r\n\r\n")
SCHEMA = "page_id long, url string, html string"


def pages():
    rows = []
    for i in range(60):
        html = "<html>%d " % (i // 3 if i % 2 else i) + "é" * (i * 9)
        if i % 7 == 0:
            html += FAKE * (1 + i % 3) + "tail"
        if i % 11 == 0:
            html = warc.MAGIC
        if i % 13 == 0:
            html = None
        rows.append((i, f"http://a/{i}\r\nContent-Length: 1", html))
    rows[20] = (20, None, FAKE)
    rows[21] = (21, "", "x" * 5000 + warc.RECORD_END + FAKE + warc.MAGIC + "\r\n")
    rows += [(100 + i, "u", "same page " * 20) for i in range(9)] + [(200 + i, "u", "short") for i in range(3)]
    return rows


def expected(rows):
    first, out = {}, {}
    for i, _, html in sorted(rows):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        response = first.setdefault(digest, i) if len(data) >= 100 else i
        out[i] = (len(data), digest, "response" if response == i else "revisit", None if response == i else response)
    return out


@pytest.fixture
def small_blocks(spark):
    """Blocks far smaller than files, so that chains and records run over many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "500"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_round_trip_rejects_magic_inside_payloads(spark, small_blocks):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("record_type", F.lit("clash")).repartition(3)
    found = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert {i: tuple(r)[3:7] for i, r in found.items()} == expected(rows)
    assert all(r.intact for r in found.values())


def test_a_false_start_is_no_record(spark, tmp_path):
    """A file that does not begin with a record has none, whatever it holds further on."""
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc").write_bytes(b"noise" + FAKE.encode())
    (folder / "b.warc").write_bytes(FAKE.encode() * 2 + b"noise" + FAKE.encode())
    assert warc.read_archives(spark, str(folder)).count() == 2


def test_damage_shows(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "y" * 200)], SCHEMA).coalesce(1)
    folder = tmp_path / "w"
    warc.write_archives(df, str(folder))
    part = next(p for p in folder.iterdir() if p.name.startswith("part"))
    part.write_bytes(part.read_bytes().replace(b"y" * 200, b"y" * 199 + b"z"))
    (folder / f".{part.name}.crc").unlink()
    assert {r.page_id: r.intact for r in warc.read_archives(spark, str(folder)).collect()} == {1: True, 2: False}


def test_null_keys_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, None, "z" * 120), (3, "u", "z" * 120), (3, "u", "z" * 120), (5, "u", "z" * 120)], SCHEMA)
    rows = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    assert rows == [(0, "revisit", 3), (3, "response", None), (3, "response", None), (5, "revisit", 3)]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_payloads_that_reach_over_many_blocks(spark, small_blocks, tmp_path):
    """A record whose pieces fill blocks without a record of their own, and records that follow it."""
    body = ("word " * 30 + FAKE) * 150
    rows = [(1, "u", "short"), (2, "u", body), (3, "u", "z" * 150), (4, "u", body + "tail"), (5, "u", "end")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    found = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert {i: tuple(r)[3:7] for i, r in found.items()} == expected(rows)
    assert all(r.intact for r in found.values())
