import hashlib

import zstandard

from qrelmill.llm import warc
from qrelmill.llm.work import Work

SCHEMA = "page_id long, url string, html string, kept string"


def pages(spark):
    long = "<p>" + "x" * 1200 + "</p>"
    rows = [(i, f"http://a/{i}", long, "q") for i in (3, 9, 5)]
    rows += [(i, None, "short", None) for i in (1, 2)]
    rows += [(10, "http://b/\r\nX: y", None, ""), (11, "u", "", ""), (12, "u", "é" * 999, ""), (13, "v", "é" * 999, "")]
    rows += [(None, "n", long, ""), (None, "n", "y" * 2000, ""), (20, "r", "z" * 3000, ""), (20, "r", "z" * 3000, "")]
    rows += [(14, "w", "\r\n\r\n" * 400 + "WARC/1.1\r\n", ""), (15, "big", "ab" * 700_000, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def expected(rows):
    groups = {}
    for r in rows:
        data = (r["html"] or "").encode()
        if len(data) >= 1000:
            groups.setdefault(data, []).append(r["page_id"])
    out = []
    for r in rows:
        data = (r["html"] or "").encode()
        best = max((i for i in groups.get(data, []) if i is not None), default=None)
        revisit = best is not None and r["page_id"] != best
        out.append(
            (r["page_id"], len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else None)
        )
    return sorted(out, key=str)


def test_archive_reads_back(spark):
    p = pages(spark)
    assert sorted(map(tuple, warc.archive(p).collect()), key=str) == expected(p.collect())
    assert warc.archive(p.limit(0)).count() == 0


def test_bundles_are_zstandard_and_seekable(spark):
    work = Work(spark, "warc-test")
    p = pages(spark)
    warc.write_bundles(warc.plan_records(p, work), work.path("b"), frame_bytes=3000, bundle_bytes=4000)
    files = spark.read.format("binaryFile").load(work.path("b")).filter("length > 4").collect()
    assert len(files) > 1
    for f in files:
        whole = zstandard.ZstdDecompressor().stream_reader(bytes(f["content"]), read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\nWARC-Type") >= 1
        table = warc.seek_table(bytes(f["content"]))
        assert sum(raw for _, _, raw in table) == len(whole)
    read = {r["record_id"]: r for r in warc.read_bundles(spark, work.path("b")).collect()}
    index = warc.build_index(spark, work.path("b"))
    ids = spark.createDataFrame([("urn:x-page:12",), ("urn:x-page:15",), ("urn:x-page:nothing",)], "record_id string")
    got = {r["record_id"]: bytes(r["payload"]) for r in warc.fetch(spark, work.path("b"), index, ids).collect()}
    assert set(got) == {"urn:x-page:12", "urn:x-page:15"} or read["urn:x-page:12"]["record_type"] == "revisit"
    assert got["urn:x-page:15"] == b"ab" * 700_000
