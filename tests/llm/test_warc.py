import gzip
import io

import pyarrow as pa
import pytest

from cellweave.llm import warc
from harness import compare, write


def rows(texts):
    return {"page_id": pa.array([*range(len(texts) - 2), None, 3], pa.int64()), "html": pa.array(texts, pa.string()),
            "url": pa.array([None if i % 5 == 0 else f"http://e.com/{i} \r\nx: y é%20" for i in range(len(texts))], pa.string()),
            "key": ["k"] * len(texts), "payload": [1] * len(texts)}


TEXTS = [None, "", "a", "é" * 600, "b" * 1000, "b" * 1000, "b" * 1000, "c" * 999, "c" * 999, "WARC/1.1\r\n\r\n" * 200, "z" * 300_000,
         "x\r\n\r\ny" * 500, "é" * 600, "", "d" * 5000, "d" * 5000, "e" * 3000, "b" * 1000, "\x00\n" * 700, "é" * 600]


def test_matches_sql(spark, tmp_path):
    folder = write(tmp_path, pages=rows(TEXTS))
    got = compare(spark, warc.op10_warc, warc.OP10_SQL, folder, ["pages"])
    assert len(got) == len(TEXTS) and sum("revisit" in r for r in got) >= 4


def test_given_pages(spark):
    compare(spark, warc.op10_warc, warc.OP10_SQL, "/root/testdata/sf0.001", ["pages"])


def test_empty(spark, tmp_path):
    folder = write(tmp_path, pages={"page_id": pa.array([], pa.int64()), "url": pa.array([], pa.string()), "html": pa.array([], pa.string())})
    assert warc.op10_warc(spark, folder).collect() == []


def test_payloads_uris_and_filters(spark, tmp_path):
    folder = write(tmp_path, pages=rows(TEXTS))
    path = str(tmp_path / "archive")
    warc.write_archive(spark.read.parquet(f"{folder}/pages.parquet"), path)
    got = {r.record_id: r for r in warc.read_archive(spark, path).where("record_type = 'response'").collect()}
    assert bytes(got["<urn:page:10>"].payload) == b"z" * 300_000 and bytes(got["<urn:page:9>"].payload).startswith(b"WARC/1.1\r\n\r\n")
    assert got["<urn:page:1>"].target_uri == "http://e.com/1%20%0D%0Ax:%20y%20é%20"
    some = warc.read_archive(spark, path).where("target_uri like 'http://e.com/1%' and record_type in ('revisit', 'response')")
    assert "StringStartsWith" not in some._jdf.queryExecution().executedPlan().toString().replace("PushedFilters", "")
    assert {r.target_uri[:13] for r in some.collect()} == {"http://e.com/1"[:13]}


def test_plain_and_foreign_files():
    record = {"record_id": "<a>", "record_type": "response", "target_uri": "u", "date": None, "payload_digest": None, "refers_to": None,
              "payload_bytes": None, "payload": b"p" * 50_000}
    plain = b"".join(warc.record_bytes({**record, "record_id": f"<{i}>"}) for i in range(5))
    foreign = b"".join(gzip.compress(warc.record_bytes({**record, "record_id": f"<{i}>"})) for i in range(5))
    own = b"".join(warc.gzip_member(warc.record_bytes({**record, "record_id": f"<{i}>"})) for i in range(5))
    for data in (plain, foreign, own):
        for with_payload in (True, False):
            got = list(warc.read_records(io.BytesIO(data), len(data), lambda r: r["record_id"] != "<2>", with_payload))
            assert [r["record_id"] for r in got] == ["<0>", "<1>", "<3>", "<4>"] and all(r["payload_bytes"] == 50_000 for r in got)
            assert not with_payload or all(r["payload"] == b"p" * 50_000 for r in got)
    assert gzip.decompress(own) == plain
    for broken in (own[:-9], foreign[:-9]):
        with pytest.raises((ValueError, EOFError)):
            list(warc.read_records(io.BytesIO(broken), len(broken), lambda r: True, True))
