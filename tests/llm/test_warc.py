import collections
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from candlewick.llm import warc
from candlewick.llm.queries import op4_warc
from candlewick.llm.warc import build_record, page_id_of, parse_record, read_records, read_warc, write_archive, write_warc
from tests.conftest import SF001


def brute(pages):
    by = collections.defaultdict(list)
    for i, html in pages:
        by[html or ""].append(i)
    out = []
    for html, ids in by.items():
        raw = html.encode()
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(raw) >= 1000 and top is not None and i != top
            out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


def result(records):
    return sorted((tuple(r) for r in records.select(
        page_id_of("record_id").cast("long"), "payload_bytes", "payload_digest", "record_type",
        page_id_of("refers_to").cast("long")).collect()), key=key)


def test_query_equals_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in op4_warc(spark, SF001).collect()), key=key) == sorted(brute(pages), key=key)


BIG = "<p>Größe</p>" * 100
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (3, None, BIG), (None, "http://a/n", BIG),
         (4, "http://a/ 4\r\nX-Evil: 1", "small"), (5, "", "small"), (6, "u", None), (7, "u", ""), (8, "u", "x" * 999),
         (9, "u", "x" * 999), (10, "u", "y" * 3_000_000), (None, None, None), (11, "u", "z" * 1000), (12, "u", "z" * 1000)]


@pytest.mark.parametrize("bound", [1, 4000, 64 << 20])
def test_revisits_edges_and_rolling(spark, bound):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(
        "*", "'own' AS digest", "1 AS size", "2 AS id", "'p' AS payload")
    made = write_warc(pages, archive_bytes=bound)
    records = read_warc(made)
    assert result(records) == sorted(brute([(i, h) for i, _, h in PAGES]), key=key)
    assert made.agg(F.sum("records")).head()[0] == len(PAGES)
    got = {r.record_id: r for r in records.collect()}
    assert bytes(got["urn:page:10"].payload) == b"y" * 3_000_000 and got["urn:page:1"].payload is None
    assert got["urn:page:4"].target_uri == "http://a/%204%0D%0AX-Evil:%201" and got["urn:page:5"].target_uri is None


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(write_warc(pages)).count() == 0


def archive(n=400):
    out = io.BytesIO()
    payloads = [f"<html>{i} some page text that repeats {'abc def ' * 60}</html>".encode() for i in range(n)]
    digests = [hashlib.sha1(p).hexdigest() for p in payloads]
    write_archive(out, (build_record(i, f"http://x/{i}", p, d, None, False) for i, (p, d) in enumerate(zip(payloads, digests))))
    return out.getvalue(), payloads


def test_dictionary_frame_and_one_frame_per_record():
    raw, payloads = archive()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICTIONARY_MAGIC
    d = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8:8 + size]))
    got = list(read_records(io.BytesIO(raw), "a"))
    assert [r["payload"] for r in got] == payloads and got[0]["frame"] == 8 + size
    for r in got[::97]:  # each frame is decoded alone
        one = zstandard.ZstdDecompressor(dict_data=d).decompressobj().decompress(raw[r["frame"]:])
        assert parse_record(one)["record_id"] == r["record_id"]
    # a plain dictionary and an unrelated skippable frame are read as well
    plain = struct.pack("<II", magic, len(d.as_bytes())) + d.as_bytes() + struct.pack("<II", 0x184D2A50, 3) + b"xyz" + raw[8 + size:]
    assert [r["payload"] for r in read_records(io.BytesIO(plain), "a")] == payloads


def test_faults_are_found():
    raw, payloads = archive()
    good = build_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    for bad, what in ((good.replace(b"WARC/1.1", b"WARC/9.9"), "version"), (good + b"x", "Content-Length"),
                      (good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"), "digest"),
                      (good.replace(b"WARC-Date", b"X-Date"), "warc-date"),
                      (good.replace(b"WARC-Payload-Length: 7", b"WARC-Payload-Length: 8"), "length"),
                      (good.replace(b"WARC-Type: response", b"WARC-Type response"), "header line")):
        with pytest.raises(ValueError, match=what):
            parse_record(bad)
    with pytest.raises(ValueError, match="ends inside"):
        list(read_records(io.BytesIO(raw[:-5]), "a"))
    broken = bytearray(raw)
    broken[len(raw) // 2] ^= 0xFF
    told = list(read_records(io.BytesIO(bytes(broken)), "a", strict=False))
    assert any(r["error"] for r in told) and all(r["payload"] in payloads for r in told if not r["error"])


def test_a_hot_payload_is_split(spark):
    """A third of all pages with one payload: the join by digest is two plain
    shuffles, which adaptive execution splits at the hot digest."""
    pages = spark.range(30_000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, 2000).otherwise(2000 + F.col("id") % 7).cast("long").alias("size"),
        F.sha1(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary")).alias("digest"))
    own = {"spark.sql.shuffle.partitions": "48", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        again = warc.revisits(pages, "page_id", "digest", "size")
        got = again.collect()
        plan = again._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(got) == 9_999 and {r.refers_to for r in got} == {29_997}
    assert "skew=true" in plan
