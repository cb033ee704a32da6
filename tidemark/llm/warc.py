"""Deterministic sharded WARC writer, and a reader of its archives.

Records are sorted by id, then payload digest, and cut into shards by ranges of
both, of about ``SHARD_BYTES`` of payload (more where that would make over
``MAX_SHARDS``): an id that many rows share, or a third of all rows without an
id, lies in as many shards as its bytes ask for. The bounds part the bytes of
the records whose hash falls into a class chosen from the row count, so they
depend on the records alone: the same records give the same files on any
cluster and after any retry. A shard is one task's sorted stream; it rolls to a new file when the compressed size
reaches ``FILE_BYTES``. Each record is a gzip member of its own. HTTP headers,
lengths, payload and block digests and record ids are made anew from the
payload; dates are a parameter, never the clock.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one
with the largest id is a response and the others are revisits that refer to it.

Commit: a task writes under a temporary name of its attempt and returns the
file's manifest row; Spark's own output committer keeps one attempt's rows. A
second distributed pass moves the files named there to their final names (an
already moved file is left), and the manifest of the final names is written
last: an archive without ``manifest/_SUCCESS`` is not complete. Files of lost
attempts stay under ``_temporary`` and are never read.

Defined cases: a null payload is empty; a null URL is written as the empty
string and read back as null; a null id has no id header and reads back null,
is never referred to while another id is there. Repeated rows each get a
record: of rows with the same id and payload one is the response, the others
revisit it. An empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound, col, shared_path, ship_package

REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
FILE_BYTES = 4 << 20
MAX_SHARDS = 65_536  # beyond this many, 2 TB of payload, the shards grow instead: their bounds are one constant of the plan
DATE = "2024-01-01T00:00:00Z"
_SAMPLE = 16_384  # records looked at for the bounds, in the mean, or eight a shard
_NO_ID = -(2**63)  # where rows without an id stand in the order
_MANIFEST = "shard int, seq int, temporary string, name string, records long, bytes long, sha1 string"
_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(kind: str, page_id: int | None, sha1: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{page_id}/{sha1}/{copy}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int, date: str = DATE) -> bytes:
    """One record, uncompressed; ``refers_to`` or ``copy`` > 0 on a repeated payload make a revisit."""
    revisit = refers_to is not None or copy > 0
    sha1 = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    head += [f"WARC-Record-ID: {_record_id('revisit' if revisit else 'response', page_id, sha1, copy)}", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id('response', refers_to, sha1, 0)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    head += [f"WARC-Payload-Digest: {_digest(payload)}", f"WARC-Block-Digest: {_digest(block)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


class _Roller:
    """The files of one shard, one at a time."""

    def __init__(self, root: str, shard: int, file_bytes: int):
        self.store, self.path = _store(root)
        self.shard, self.limit, self.seq, self.out = shard, file_bytes, 0, None
        self.attempt = uuid.uuid4().hex

    def add(self, data: bytes) -> Iterator[tuple]:
        member = io.BytesIO()
        with gzip.GzipFile(fileobj=member, mode="wb", compresslevel=6, mtime=0, filename="") as z:
            z.write(data)
        packed = member.getvalue()
        if self.out is None:
            self.temporary = f"_temporary/{self.attempt}-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.out = self.store.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha1()
        self.out.write(packed)
        self.records, self.bytes = self.records + 1, self.bytes + len(packed)
        self.sum.update(packed)
        if self.bytes >= self.limit:
            yield self.close()

    def close(self) -> tuple:
        self.out.close()
        row = (self.shard, self.seq, self.temporary, f"pages-{self.shard:05d}-{self.seq:05d}.warc.gz", self.records, self.bytes, self.sum.hexdigest())
        self.out, self.seq = None, self.seq + 1
        return row


def _place() -> Column:
    """A record's place in the order: its id, and the beginning of its payload's digest as a number."""
    return F.struct(F.coalesce("page_id", F.lit(_NO_ID)).alias("i"), F.conv(F.substring("sha1", 1, 15), 16, 10).cast("long").alias("h"))


def _bounds(rows: DataFrame, shards: int, count: int) -> list[tuple[int, int]]:
    """Lower ends of all shards but the first, from the records of one hash class: by the records alone."""
    classes = 1 << max(0, (count // max(_SAMPLE, 8 * shards)).bit_length())
    name = F.concat_ws(":", F.col("page_id").cast("string"), F.col("sha1"))
    sample = rows.filter(F.pmod(F.crc32(name.cast("binary")), F.lit(classes)) == 0).select(_place().alias("p"), (F.octet_length("payload") + 1).alias("size"))
    found = sample.groupBy("p").agg(F.sum("size").alias("size")).select("p.i", "p.h", "size").toArrow().to_pandas()  # about _SAMPLE rows, or eight a shard
    found = found.sort_values(["i", "h"], ignore_index=True)
    before = found["size"].cumsum() - found["size"]
    shard = (before * shards // max(1, int(found["size"].sum()))).astype(int)
    first = found[shard != shard.shift(fill_value=0)]
    return list(zip(first["i"].tolist(), first["h"].tolist()))


def _shard(bounds: list[tuple[int, int]]) -> Column:
    """How many bounds a record's place reaches, by binary search over one constant."""
    if not bounds:
        return F.lit(0)
    edges = F.from_json(F.lit(json.dumps([{"i": i, "h": h} for i, h in bounds])), "array<struct<i:bigint,h:bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    search = lambda p: F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.try_element_at(edges, at + step) <= p, at + step).otherwise(at))
    return bound(_place(), search)


def write_warc(
    pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", payload: str = "html", file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write ``pages`` as an archive under ``root`` (a folder every executor reaches)."""
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(
        col(page_id).cast("long").alias("page_id"), col(url).cast("string").alias("url"), F.coalesce(col(payload).cast("string").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    # the largest id of each repeated payload: counted without the payloads, combined before the shuffle
    first = rows.filter(large).groupBy("sha1").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0))).first()
    shards = min(MAX_SHARDS, max(1, -(-size // shard_bytes)))
    bounds = _bounds(rows, shards, n)
    rows = rows.withColumn("shard", _shard(bounds))
    # which response a repeated payload refers to goes to the shard as a row of its own, sorted before the
    # page's: payloads are shuffled once, to their shards, and not to meet their digests
    notes = rows.filter(large).select("shard", "page_id", "sha1").distinct().join(first, "sha1")
    notes = notes.select("shard", "page_id", "sha1", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "response_id")
    records_ = rows.select("shard", "page_id", "sha1", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("response_id"))
    store, path = _store(root)
    store.create_dir(f"{path}/_temporary", recursive=True)
    dealt = notes.unionByName(records_).repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "sha1", "kind", "url")

    columns = ["page_id", "url", "payload", "sha1", "response_id", "shard", "kind"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, before, copy, noted = None, None, 0, None
        for batch in batches:
            done: list[tuple] = []
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i].as_py() for x in columns}
                if row["kind"] == 0:
                    noted = (row["page_id"], row["sha1"], row["response_id"])
                    continue
                response = noted[2] if noted is not None and noted[:2] == (row["page_id"], row["sha1"]) else None
                if roller is None or roller.shard != row["shard"]:
                    if roller is not None and roller.out is not None:
                        done.append(roller.close())
                    roller = _Roller(root, row["shard"], file_bytes)
                # equal rows stand next to each other: the first of those with the response's id is the response
                copy = copy + 1 if before == (row["page_id"], row["sha1"]) else 0
                before = (row["page_id"], row["sha1"])
                large = len(row["payload"]) >= REVISIT_BYTES
                refers = response if large and (copy or response != row["page_id"]) else None
                revisits = refers is not None or (large and copy > 0)
                done += roller.add(record(row["page_id"], row["url"], row["payload"], refers, copy) if revisits or not copy else _again(row, copy))
            if done:
                yield _manifest(done)
        if roller is not None and roller.out is not None:
            yield _manifest([roller.close()])

    dealt.select(*columns).mapInArrow(write, _MANIFEST).write.parquet(f"{root}/_written")  # one attempt of each task counts
    _publish(spark, root)


def _again(row: dict, copy: int) -> bytes:
    """A repeated small row: a response with a record id of its own."""
    data = record(row["page_id"], row["url"], row["payload"], None, 0)
    sha1 = hashlib.sha1(row["payload"]).hexdigest()
    return data.replace(_record_id("response", row["page_id"], sha1, 0).encode(), _record_id("response", row["page_id"], sha1, copy).encode(), 1)


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in _MANIFEST.split(", ")])


def _publish(spark: SparkSession, root: str) -> None:
    """Move the committed files to their final names, then write the manifest."""
    files = spark.read.schema(_MANIFEST).parquet(f"{root}/_written")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(root)
        for batch in batches:
            for temporary, name in zip(batch["temporary"].to_pylist(), batch["name"].to_pylist()):
                if store.get_file_info(f"{path}/{temporary}").type == fs.FileType.File:
                    store.move(f"{path}/{temporary}", f"{path}/{name}")
                elif store.get_file_info(f"{path}/{name}").type != fs.FileType.File:
                    raise OSError(f"{temporary} is neither there nor moved to {name}")
            yield batch

    files.mapInArrow(move, _MANIFEST).write.parquet(f"{root}/manifest")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open ``.warc.gz`` stream, member by member."""
    unpack, held, raw = zlib.decompressobj(31), [], b""
    while True:
        if unpack.eof:
            held, raw = [], unpack.unused_data
            unpack = zlib.decompressobj(31)
        else:
            raw = stream.read(1 << 16)
            if not raw:
                return
        held.append(unpack.decompress(raw))
        if unpack.eof:  # put together once, however many reads the record took
            head, _, rest = b"".join(held).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            yield fields, rest[: int(fields["Content-Length"])]


def _parsed(fields: dict[str, str], block: bytes) -> tuple:
    if fields["WARC-Block-Digest"] != _digest(block):
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not hold")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    revisit = fields["WARC-Type"] == "revisit"
    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
    if not revisit and hashlib.sha1(payload).hexdigest() != sha1:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not hold")
    number = lambda x: int(fields[x]) if x in fields else None
    return number("X-Page-Id"), fields["WARC-Target-URI"] or None, fields["WARC-Type"], size, sha1, number("X-Refers-To-Page-Id"), None if revisit else payload


def read_warc(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """The archive's records, checked against their digests; files stream through the tasks one record at a time."""
    ship_package(spark)
    files = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    spread = max(1, min(files.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(root)
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for name in batch["name"].to_pylist():
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for fields, block in records(stream):
                        row = _parsed(fields, block)
                        rows.append(row if payloads else (*row[:-1], None))
                        held += len(block) if payloads else 0
                        if len(rows) >= 2000 or held >= 4 << 20:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    return files.select("name").repartition(spread, "name").mapInArrow(read, _READ)


def archived(pages: DataFrame, name: str = "warc") -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back."""
    root = shared_path(pages.sparkSession, name)
    write_warc(pages, root)
    return read_warc(pages.sparkSession, root, payloads=False)
