"""WARC archives: a deterministic sharded writer, and a reader.

Records are sorted by page id and dealt to ranges of equal bytes, whose boundaries come
from exact counts and not from a sample, so the same pages always give the same files. A
task writes one range, rolling to a new file by compressed size. Each file is written
under a temporary name and renamed; a repeated attempt makes the same bytes under the same
name. The manifest, written last, names the files that count.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import sha256
from newsloom.llm.histogram_sort import Histogram
from newsloom.settings import staged

# Payloads of fewer bytes are always stored in full.
LEAST_BYTES = 100
RANGE_BYTES, FILE_BYTES = 32 << 20, 16 << 20
DATE = "2026-01-01T00:00:00Z"
# Names of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member of its own, without a time stamp."""
    named = [*fields, ("WARC-Block-Digest", "sha256:" + sha256(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in named if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def _urn(*parts: object) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts))).urn}>"


def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit that names the page whose response has the payload."""
    digest = sha256(payload)
    place = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", place),
        ("WARC-Payload-Digest", "sha256:" + digest),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-Id", None if page_id is None else str(page_id)),
    ]
    if refers_to is None:
        return _record(fields, _http(len(payload)) + payload)
    fields += [
        ("WARC-Profile", SAME_PAYLOAD),
        ("WARC-Refers-To", _urn(refers_to, digest)),
        ("X-Refers-To-Page-Id", str(refers_to)),
    ]
    return _record(fields, _http(len(payload)))


def _order(page_id: Column) -> Column:
    """Key of 17 hex digits in the order of the ids, nulls first."""
    shifted = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.coalesce(F.concat(F.lit("1"), shifted), F.lit("0" * 17))


def _write_range(folder: str, file_bytes: int, date: str):
    """The function that writes the sorted rows of a range and returns rows of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        held: list[bytes] = []
        made: list[tuple] = []
        shard = 0

        def info(name: str) -> bytes:
            fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(name)), ("WARC-Date", date),
                      ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
            return _record(fields, b"format: WARC File Format 1.1\r\n")

        def close() -> None:
            name = f"pages-{shard:06d}-{len(made):04d}.warc.gz"
            data = b"".join([info(name), *held])
            temporary = f"{base}/_temporary/{name}.{uuid.uuid4().hex}"
            store.create_dir(f"{base}/_temporary", recursive=True)
            with store.open_output_stream(temporary, compression=None) as out:
                out.write(data)
            store.move(temporary, f"{base}/{name}")
            made.append((name, len(held), len(data), sha256(data)))
            held.clear()

        size = 0
        page: object = run  # no page id yet
        first_of: dict[str, int] = {}
        done: set[str] = set()
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                if row["page_id"] != page:
                    page, first_of, done = row["page_id"], {}, set()
                if row["refers_to"] is not None:
                    first_of[row["digest"]] = row["refers_to"]
                    continue
                payload = row["payload"]
                first = first_of.get(row["digest"])
                if first is not None and first == page and row["digest"] not in done:
                    first = None
                done.add(row["digest"])
                record = page_record(page, row["url"], payload, first, date)
                if held and size + len(record) > file_bytes:
                    close()
                    size = 0
                held.append(record)
                size += len(record)
        if held:
            close()
        if made:
            columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "records", "bytes", "sha256"])

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    least_bytes: int = LEAST_BYTES,
    range_bytes: int = RANGE_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> None:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) under ``folder``.

    Of rows with equal payloads of at least ``least_bytes``, the one with the smallest page id
    is a response and the others are revisits of it. A null html is an empty payload; a row
    without page id is kept, and is never what others refer to. Rows that repeat a page id
    count as ties: one of them is the response. Other columns are not stored. The html
    is shuffled once; which rows repeat is found on digests alone. ``folder`` is a URI that
    pyarrow can write to from the executors (file:, hdfs:, s3:, gs:, abfs:).
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    full = pages.select("page_id", "url", payload.alias("payload"))
    digest = F.sha2("payload", 256).alias("digest")
    narrow = staged(full.select("page_id", F.octet_length("payload").alias("n"), digest), "warc-digests")
    long = narrow.filter(F.col("n") >= least_bytes)
    first = (
        long.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) & F.col("refers_to").isNotNull())
        .drop("rows")
    )
    refers = long.select("page_id", "digest").join(first, "digest")
    total = narrow.agg(F.sum(F.col("n") + 1)).first()[0] or 0
    ranges = max(1, -(-total // range_bytes))
    cells = Histogram(narrow, _order(F.col("page_id")), F.col("n") + 1, ranges, 0.1)
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("url", "string"), ("payload", "binary"))]
    both = full.select("page_id", "url", "payload", digest, F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        refers.select("page_id", *empty, "digest", "refers_to")
    )
    placed = cells.place(both, _order(F.col("page_id"))).drop("_key", "_cell", "_before")
    # Within a page id the notes on revisits come first, then its rows in a fixed order.
    sorted_ranges = placed.repartitionById(ranges, F.col("shard")).sortWithinPartitions(
        "page_id", F.col("refers_to").isNull(), "url", "digest"
    )
    manifest = sorted_ranges.mapInArrow(
        _write_range(folder, file_bytes, date), "file string, records bigint, bytes bigint, sha256 string"
    )
    manifest.write.mode("overwrite").json(f"{folder}/{MANIFEST}")


READ = "file string, record_type string, page_id bigint, url string, payload_bytes bigint, payload_digest string, refers_to bigint"


def members(data: bytes, piece: int = 1 << 14) -> Iterator[bytes]:
    """The gzip members of a file. It is fed in small pieces, as what is left of a piece
    behind a member is copied."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the archive is cut off")
            fed = view[at : at + piece]
            parts.append(unpacker.decompress(fed))
            at += len(fed)
        at -= len(unpacker.unused_data)
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def read_archives(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """A row per record of the archives in the manifest, with ``payload`` if asked for.

    The digest of every block and stored payload is computed again; a record that
    differs from its header fails the read. For revisits, bytes and digest are those of
    the full payload. Without a finished manifest there is nothing to read.
    """
    schema = READ + (", payload binary" if payload else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [row for row in _rows(file, content.as_py(), payload) if row]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, schema.split(", "))])
    listed = spark.read.schema("file string").json(f"{folder}/{MANIFEST}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.join(F.broadcast(listed), "file", "left_semi").mapInArrow(run, schema)


def _rows(file: str, content: bytes, with_payload: bool) -> Iterator[dict | None]:
    for record in members(content):
        fields, block = parse(record)
        if "sha256:" + sha256(block) != fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {file}")
        if fields["WARC-Type"] == "warcinfo":
            continue
        head, _, body = block.partition(b"\r\n\r\n")
        stored = fields["WARC-Type"] == "response"
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if stored and sha256(body) != digest:
            raise ValueError(f"damaged payload {fields['WARC-Record-ID']} in {file}")
        length = next(x for x in head.decode("utf-8").split("\r\n") if x.startswith("Content-Length: "))
        number = lambda name: int(fields[name]) if name in fields else None
        row = {
            "file": file,
            "record_type": fields["WARC-Type"],
            "page_id": number("X-Page-Id"),
            "url": fields.get("WARC-Target-URI"),
            "payload_bytes": int(length.split(": ")[1]),
            "payload_digest": digest,
            "refers_to": number("X-Refers-To-Page-Id"),
        }
        yield row | ({"payload": body if stored else None} if with_payload else {})
