"""WARC archives: deterministic sharded writer and reader.

Writer: the id range is cut into equal cells, the payload bytes of each cell are summed (at most ``CELLS``
numbers reach the driver) and consecutive cells join into shards of about ``shard_bytes``.  The borders so
depend on the data alone, not on a sampled range partitioning.  Each shard is range-sorted by id and
streamed record by record into gzip members; a file rolls when its compressed size passes ``roll_bytes``.
Record headers, HTTP headers and digests are made anew.  A task writes under a temporary name of
its own and renames the file when it is whole; equal input gives equal bytes, so a retried or speculative task
replaces a file by the same file.  The manifest (one row per file, written as a table after all files) is
the commit: readers open only what it lists.

Equal payloads of ``min_revisit`` bytes or more: the record with the largest id is the response, the others
are revisits of it.  The groups are found on (digest, size) alone; what a record refers to
meets the record in the sort of its shard, so payloads are shuffled once and a payload that a third of the
pages share is no hot key.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import scratch_path, table

CELLS = 8192
SHARD_BYTES = 64 << 20
ROLL_BYTES = 32 << 20
MIN_REVISIT = 1000
DATE = "2020-01-01T00:00:00Z"  # the record date where the pages carry none: a constant keeps the bytes reproducible
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space for URLs
_MANIFEST = "file string, shard int, part int, records long, bytes long, sha1 string"


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def _b32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _head(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields if v is not None), "", ""]).encode()


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, '/'.join(map(str, parts)))}>"


def _target(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def make_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, copy: int,
                refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit has the HTTP headers only."""
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))])
    block = http if revisit else http + payload
    head = _head("WARC/1.1", [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest, copy)),
        ("WARC-Date", DATE), ("WARC-Target-URI", _target(url)), ("X-Page-ID", None if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{_b32(digest)}"), ("WARC-Block-Digest", f"sha1:{_b32(hashlib.sha1(block).hexdigest())}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, digest, 0) if revisit else None),
        ("X-Refers-To-Page-ID", str(refers_to) if revisit and refers_to is not None else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))])
    return _member(head + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    return gzip.compress(data, compresslevel=6, mtime=0)


class _Roll:
    """The files of one shard, each under a temporary name until it is whole."""

    def __init__(self, base: str, shard: int, roll_bytes: int):
        self.fs, self.root = _file_system(base)
        self.shard, self.part, self.roll_bytes, self.out = shard, 0, roll_bytes, None
        self.fs.create_dir(self.root, recursive=True)

    def write(self, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.tmp = f"{self.root}/.{self.name}.{uuid.uuid4().hex}.tmp"
            self.out, self.size, self.records, self.sha1 = self.fs.open_output_stream(self.tmp, compression=None), 0, 0, hashlib.sha1()
            info = b"software: geoindicators\r\nformat: WARC File Format 1.1\r\n"
            self._put(_member(_head("WARC/1.1", [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name),
                                                 ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"))
        self._put(member)
        self.records += 1
        if self.size >= self.roll_bytes:
            yield from self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.size += len(data)

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.tmp, f"{self.root}/{self.name}")
            yield self.name, self.shard, self.part, self.records, self.size, self.sha1.hexdigest()
            self.out, self.part = None, self.part + 1


def write_warc(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, min_revisit: int = MIN_REVISIT) -> tuple[str, DataFrame]:
    """Write one record per row; returns (folder, manifest).

    ids are integers; a null id sorts first and has no id header, a null url no target, a null payload is empty.
    Of repeated rows (same id, same payload) the first is written as above, the others revisit it.  An
    empty table gives no files and an empty manifest.  Other columns are ignored.
    """
    spark = pages.sparkSession
    base = path or scratch_path(spark, "warc")
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.select("id", "url", "body", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("size"))
    narrow = table(rows.select("id", "digest", "size"), "warc-digests")
    low, high = narrow.agg(F.min("id"), F.max("id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = -(-(high - low + 1) // CELLS)
    # in doubles: ids may be further apart than a long, and only the order of the cells matters
    cell = F.coalesce(F.floor((F.col("id").cast("double") - F.lit(float(low))) / F.lit(float(width))), F.lit(0)).cast("int")
    mass = {r["cell"]: r["b"] for r in narrow.groupBy(cell.alias("cell")).agg(F.sum(F.col("size") + 512).alias("b")).collect()}
    shard_of, shard, filled = [], 0, 0
    for c in range(max(mass, default=0) + 1):
        if filled and filled + mass.get(c, 0) > shard_bytes:
            shard, filled = shard + 1, 0
        filled += mass.get(c, 0)
        shard_of.append(shard)
    large = narrow.where(F.col("size") >= min_revisit)
    last = large.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(F.col("id").isNotNull(), "id"))["id"].alias("refers_to"))
    last = table(last.where("n > 1").drop("n"), "warc-last")  # else its exchange serves the join too, and AQE can't split a hot payload
    refs = large.join(last, ["digest", "size"]).where(~F.col("id").eqNullSafe(F.col("refers_to"))).distinct()
    both = rows.select("id", "digest", F.lit(1).alias("tag"), "size", "url", "body", F.lit(None).cast("long").alias("refers_to")).unionByName(
        refs.select("id", "digest", F.lit(0).alias("tag"), "size", "refers_to"), allowMissingColumns=True)
    both = both.withColumn("shard", F.get(F.lit(shard_of), cell))
    both = both.repartition(shard + 1, "shard").sortWithinPartitions("shard", "id", "digest", "tag")

    def write(batches):
        roll, ref, previous, copy = None, None, None, 0
        for b in batches:
            done = []
            for r in b.to_pylist():
                key = (r["shard"], r["id"], r["digest"])
                if r["tag"] == 0:
                    ref = (key, r["refers_to"])
                    continue
                copy, previous = (copy + 1, key) if key == previous else (0, key)
                revisit, refers_to = False, None
                if ref and ref[0] == key:
                    revisit, refers_to = True, ref[1]
                elif copy and r["size"] >= min_revisit:
                    revisit, refers_to = True, r["id"]
                if roll is None or roll.shard != r["shard"]:
                    done += list(roll.close()) if roll else []
                    roll = _Roll(base, r["shard"], roll_bytes)
                done += roll.write(make_record(r["id"], r["url"], r["body"], r["size"], r["digest"], copy, refers_to, revisit))
            if done:
                yield _batch(done, _MANIFEST)
        if roll and (done := list(roll.close())):
            yield _batch(done, _MANIFEST)

    files = table(both.mapInArrow(write, _MANIFEST), "warc-files")
    manifest = f"{base.rstrip('/')}/manifest"
    files.coalesce(1).sort("shard", "part").write.json(manifest)  # one row per file
    return base, spark.read.schema(_MANIFEST).json(manifest)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    rest, inflate, out = b"", zlib.decompressobj(31), io.BytesIO()
    while data := rest or stream.read(chunk):
        out.write(inflate.decompress(data))
        rest = inflate.unused_data
        if inflate.eof:
            yield out.getvalue()
            inflate, out = zlib.decompressobj(31), io.BytesIO()
    if out.tell():
        raise ValueError("the last gzip member is cut off")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; raises if its length is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')}: its length isn't {n}")
    return fields, rest[:n]


_PAGES = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(base: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the files in the manifest; digests of files, blocks and payloads are checked."""
    def read(batches):
        for b in batches:
            for name, records, sha1 in zip(b.column("file").to_pylist(), b.column("records").to_pylist(), b.column("sha1").to_pylist(), strict=True):
                fs, root = _file_system(base)
                seen, whole, rows = 0, hashlib.sha1(), []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(_Hashed(stream, whole)):
                        fields, block = parse_record(member)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_row(fields, block, with_payload))
                        seen += 1
                        if len(rows) == 1000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)
                if (seen, whole.hexdigest()) != (records, sha1):
                    raise ValueError(f"{name} is not the file of the manifest")

    # a file is the unit of reading: deal the files out, one after the other
    files = manifest.select("file", "records", "sha1").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, _PAGES).drop(*([] if with_payload else ["payload"]))


class _Hashed:
    def __init__(self, stream, digest):
        self.stream, self.digest = stream, digest

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.digest.update(data)
        return data


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if base64.b32decode(fields["WARC-Block-Digest"].removeprefix("sha1:")) != hashlib.sha1(block).digest():
        raise ValueError(f"record {fields['WARC-Record-ID']}: its block doesn't match its digest")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: its payload doesn't match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return (number("X-Page-ID"), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], number("X-Refers-To-Page-ID"),
            payload if with_payload and fields["WARC-Type"] == "response" else None)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in _PAGES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
