import base64
import gzip
import hashlib

import pytest

from alertloom.llm import warc

SCHEMA = "page_id long, url string, html string, row long, capture_id string"


def pages(spark, tmp_path, rows):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        last = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        revisit = len(data) >= least and page != last
        out.append((page, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example/x?y=1", "<p>one</p>"),
    (2, "http://b.example/", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (4, "http://c.example/with space\r\nX: y", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (5, "http://[bad", None),
    (6, "", ""),
    (None, "http://n.example/", "<p>null id</p>"),
    (None, "http://n.example/", "<p>one</p>"),
    (7, "http://d.example/", "z" * 300_000),
]


def digests(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=repr)


def test_round_trip(spark, tmp_path):
    assert digests(warc.archive_round_trip(pages(spark, tmp_path, ROWS))) == expected(ROWS)


def test_small_payloads_are_responses(spark, tmp_path):
    assert digests(warc.archive_round_trip(pages(spark, tmp_path, ROWS), least=11)) == expected(ROWS, 11)


def test_repeated_rows_have_one_response(spark, tmp_path):
    got = digests(warc.archive_round_trip(pages(spark, tmp_path, [(9, "u", "same")] * 3)))
    assert sorted(r[3] for r in got) == ["response", "revisit", "revisit"]
    assert sorted(r[4] or 0 for r in got) == [0, 9, 9]


def test_captures_hold_their_records(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archives(pages(spark, tmp_path, ROWS), folder, compression="gzip")
    got = warc.assemble(warc.read_records(spark, folder)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r["request"]["content"].startswith(b"GET /")
        assert r["capture_id"] == r["response"]["record_id"]
        if r["page_id"] == 4:
            assert r["response"]["content"].decode() == ROWS[3][2]
            assert r["response"]["uri"] == "http://c.example/with%20space%0D%0AX:%20y"


def test_files_are_warc(spark, tmp_path):
    folder = tmp_path / "archive"
    warc.write_archives(pages(spark, tmp_path, ROWS), str(folder))
    kinds = []
    for f in folder.glob("part-*"):
        data = f.read_bytes()
        assert not data or data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        kinds += [h["warc-type"] for h, _ in warc.parse(data)]
    assert sorted(kinds) == sorted(["request", "metadata"] * len(ROWS) + [r[3] for r in expected(ROWS)])
    with pytest.raises(ValueError):
        list(warc.parse(data[:-30] if data else b"WARC/1.1\r\nContent-Length: 9\r\n\r\nx"))
    assert gzip


def test_lone_and_foreign_records(spark, tmp_path):
    folder = tmp_path / "foreign"
    folder.mkdir()
    head = "HTTP/1.1 200 OK\r\n\r\nhello"
    records = [
        warc._record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<w>")], "software: x\r\n"),
        warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>")], head),
        warc._record([("WARC-Type", "request"), ("WARC-Record-ID", "<b>"), ("WARC-Concurrent-To", "<gone>")], "GET / HTTP/1.1\r\n\r\n"),
        warc._record([("WARC-Type", "revisit"), ("WARC-Record-ID", "<c>"), ("WARC-Refers-To", "<a>")], "HTTP/1.1 200 OK\r\n\r\n"),
    ]
    (folder / "x.warc").write_bytes("".join(r + "\r\n\r\n" for r in records).encode())
    got = {r["capture_id"]: r for r in warc.assemble(warc.read_records(spark, str(folder))).collect()}
    assert set(got) == {"<a>", "<c>"}
    assert got["<a>"]["request"] is None and got["<a>"]["response"]["payload_bytes"] == 5
    assert got["<c>"]["response"]["payload_bytes"] is None


def test_empty_table(spark, tmp_path):
    assert warc.archive_round_trip(pages(spark, tmp_path, [])).count() == 0


def test_files_are_bounded_by_bytes(spark, tmp_path):
    sizes = [100] * 50 + [200_000] * 300 + [2_000_000] * 20 + [5_000_000] * 2
    # A long url is in every record of its page.
    rows = [(i, "http://a.example/" + "u" * (100_000 if i < 5 else 10), f"{i} " + "z" * n) for i, n in enumerate(sizes)]
    path, folder = str(tmp_path / "pages"), tmp_path / "warc"
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).coalesce(1).write.parquet(path)
    given = spark.read.parquet(path)
    warc.write_archives(given, str(folder))
    files = [f.stat().st_size for f in folder.glob("part-*")]
    assert sum(files) > sum(sizes) and max(files) < 34 << 20
    assert digests(warc.capture_digests(warc.assemble(warc.read_records(spark, str(folder))))) == expected(rows)


def test_small_pages_share_files(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", f"page {i}") for i in range(300)]
    path, folder = str(tmp_path / "pages"), tmp_path / "warc"
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).coalesce(1).write.parquet(path)
    warc.write_archives(spark.read.parquet(path), str(folder))
    assert len(list(folder.glob("part-*"))) == 1
