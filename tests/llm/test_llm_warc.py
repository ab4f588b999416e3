import gzip
import hashlib
import io

import pytest

from geoindicators.llm.warc import members, parse_record, read_warc, write_warc

SCHEMA = "page_id long, url string, html string, digest string, size string, shard string, tag string, refers_to string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


BIG, OTHER = "<p>é</p>" * 200, "<p>o</p>" * 200
ROWS = [(i, f"http://h/{i}?a=b c\r\nX: y", BIG if i % 3 == 0 else OTHER if i % 3 == 1 else f"page {i}") for i in range(200)]
ROWS += [(500, None, None), (501, "http://e/", ""), (502, "u", "page 2"), (503, "u", "x" * 999), (504, "u", "x" * 999), (505, "u", "y" * 1000), (506, "u", "y" * 1000)]


def brute(rows):
    out = []
    for i, _, t in rows:
        b = (t or "").encode()
        same = [j for j, _, u in rows if (u or "") == (t or "")]
        revisit = len(b) >= 1000 and i != max(same)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out)


def test_round_trip_over_many_files(spark, tmp_path):
    folder, manifest = write_warc(frame(spark, ROWS), f"file://{tmp_path}/w", shard_bytes=40_000, roll_bytes=2_000)
    got = read_warc(folder, manifest, with_payload=True).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(ROWS)
    want = {i: (t or "").encode() for i, _, t in ROWS}
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) == want[r.page_id] for r in got)
    files = manifest.collect()
    assert len({f.shard for f in files}) > 3 and max(f.part for f in files) > 0
    assert sorted(p.name for p in (tmp_path / "w").glob("*.warc.gz")) == sorted(f.file for f in files)
    assert not list((tmp_path / "w").glob(".*tmp"))
    # in range order over shards and parts
    ids = []
    for f in sorted(files, key=lambda f: (f.shard, f.part)):
        with open(tmp_path / "w" / f.file, "rb") as s:
            heads = [parse_record(m)[0] for m in members(s)]
        assert heads[0]["WARC-Type"] == "warcinfo"
        ids += [int(h["X-Page-ID"]) for h in heads[1:]]
    assert ids == sorted(ids)


def test_the_same_input_gives_the_same_bytes(spark, tmp_path):
    a = write_warc(frame(spark, ROWS), str(tmp_path / "a"), shard_bytes=40_000, roll_bytes=2_000)[1].collect()
    b = write_warc(frame(spark, ROWS).repartition(9), str(tmp_path / "b"), shard_bytes=40_000, roll_bytes=2_000)[1].collect()
    assert sorted(a) == sorted(b) and a


def test_repeated_rows_null_ids_and_empty_table(spark, tmp_path):
    rows = [(1, "u", BIG), (1, "u", BIG), (2, "u", BIG), (2, "u", BIG), (None, "u", BIG), (None, "u", "small"), (7, "u", "small"), (7, "u", "small")]
    folder, manifest = write_warc(frame(spark, rows), str(tmp_path / "r"))
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in read_warc(folder, manifest).collect())
    assert got == sorted([("1", "revisit", 2), ("1", "revisit", 2), ("2", "response", None), ("2", "revisit", 2), ("None", "revisit", 2),
                          ("None", "response", None), ("7", "response", None), ("7", "response", None)])
    folder, manifest = write_warc(frame(spark, []), str(tmp_path / "e"))
    assert manifest.collect() == [] and read_warc(folder, manifest).collect() == []


def test_damage_is_found(spark, tmp_path):
    folder, manifest = write_warc(frame(spark, ROWS[:5]), str(tmp_path / "d"))
    [f] = manifest.collect()
    data = (tmp_path / "d" / f.file).read_bytes()
    with open(tmp_path / "d" / f.file, "wb") as out:
        for m in members(io.BytesIO(data)):
            out.write(gzip.compress(m.replace(b"page 2", b"page 3"), mtime=0))
    with pytest.raises(Exception, match="doesn't match its digest|not the file"):
        read_warc(folder, manifest).collect()


def test_a_very_long_page(spark, tmp_path):
    folder, manifest = write_warc(frame(spark, [(1, "u", "z" * 5_000_000)]), str(tmp_path / "l"))
    [r] = read_warc(folder, manifest).collect()
    assert r.payload_bytes == 5_000_000


def test_ids_at_both_ends_of_a_long(spark):
    big = (1 << 63) - 1
    rows = [(-big, "u", "a" * 2000), (0, "u", "b"), (1, "u", "a" * 2000), (big, "u", "a" * 2000), (big - 1, "u", "c"), (None, "u", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in read_warc(*write_warc(pages)).collect()}
    assert got == {-big: ("revisit", big), 0: ("response", None), 1: ("revisit", big), big: ("response", None), big - 1: ("response", None), None: ("response", None)}
