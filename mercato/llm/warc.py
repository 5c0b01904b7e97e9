"""WARC archives: a normaliser of monolithic gzip files, with an offset index.

A crawl often leaves whole files as one gzip stream, which can only be read
from the start.  ``write_monolithic`` writes pages that way; ``normalise``
inflates each such stream once, in order and a record at a time, rewrites every
record as a gzip member of its own and puts a sidecar index (offset, length,
record) beside the archive; ``read_archives`` seeks to the members by that
index.  A payload that occurs again becomes a ``revisit`` record without
payload, which names the record that keeps it.

Scale.  Payloads are never shuffled: they go from table to file and from file
to file.  Only a row of ids and digests a record is (the record kept of equal
payloads is a map-side combined maximum); payloads with more than
1/``HOT_SHARE`` of all records are at most ``HOT_SHARE`` rows and broadcast, so
no key of the remaining join is hot.  An archive closes at ``ARCHIVE_BYTES`` of
records, so neither pass has a task that grows with the table.

Lost executors.  Archives get a name of their own for each attempt; the tables
that list them are committed by Spark, so a repeated task's first files are
never read.

Files go to a folder that pyarrow.fs can open by its URI (by default below
``spark.checkpoint.dir``): local shared folders, hdfs, s3, gs, abfs.

Defined cases.  A null payload is empty; an empty payload is a payload like any
other.  A null url is written as ``about:blank``; characters not allowed in a
header are percent-encoded.  Null page ids sort below all others.  Of rows with
equal payload and equal page_id one is the response, the others refer to that
page_id.  Other columns are not read.  An empty table writes no archive and
gives no rows.  One record is held in memory at a time, however long."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import slices, written
from mercato.session import scratch_path

#: Bytes of records after which an archive closes.
ARCHIVE_BYTES = 128 << 20
#: A payload with more than one in so many records is joined by broadcast.
HOT_SHARE = 1000
#: Bytes read or inflated at once.
CHUNK = 1 << 20
#: Payloads of fewer bytes are always stored themselves.
MIN_BYTES = 0
#: Date written into the records.
DATE = "2024-01-01T00:00:00Z"

GZIP = 31  # zlib's window bits for a gzip wrapper
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def _uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"".join([f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])


def _response(archive: str, number: int, page_id, url: str | None, payload: bytes) -> tuple[bytes, str]:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = digest_of(payload)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(archive, number)), ("WARC-Date", DATE),
              ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]|") if url else "about:blank"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-Id", quote(str(page_id), safe="")))
    return record_bytes(fields, http + payload), digest


class _Stream:
    """Bytes of a gzip file, inflated as they are asked for; several members
    follow each other as one stream."""

    def __init__(self, raw):
        self.raw, self.inflate, self.rest, self.held = raw, zlib.decompressobj(GZIP), b"", bytearray()

    def more(self) -> bool:
        data = self.rest or self.raw.read(CHUNK)
        if not data:
            return False
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(GZIP)
        self.held += self.inflate.decompress(data, CHUNK)
        self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held:
                    raise ValueError("archive ends within a header")
                return None
        return self.take(at + len(mark))


def _fields(head: bytes) -> list[tuple[str, str]]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return [tuple(line.split(": ", 1)) for line in lines[1:] if line]


def records(stream: _Stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record of a stream, in order."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = dict(_fields(head))
        block = stream.take(int(fields.pop("Content-Length")))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("record without end mark")
        yield fields, block


def write_monolithic(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
                     payload: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one response record a row into archives that are one gzip stream
    each; a table (archive, record, page_id, payload_bytes, digest)."""
    folder = _uri(folder or scratch_path(pages.sparkSession, "warc"))
    src = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                       F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    id_type = src.schema["page_id"].dataType
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("record", T.LongType()),
                           T.StructField("page_id", id_type), T.StructField("payload_bytes", T.LongType()),
                           T.StructField("digest", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        stem = f"{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}"
        out = packer = None
        name, number, size, made = "", 0, 0, 0

        def close():
            out.write(packer.flush())
            out.close()

        for batch in batches:
            for part in slices(batch, "payload"):
                rows = []
                for pid, link, body in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload"))):
                    if out is None:
                        fs.create_dir(base, recursive=True)
                        name, number, size, made = f"{stem}-{made:05d}.warc.gz", 0, 0, made + 1
                        out, packer = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(6, zlib.DEFLATED, GZIP)
                    record, digest = _response(name, number, pid, link, body)
                    out.write(packer.compress(record))
                    rows.append((f"{folder}/{name}", number, pid, len(body), digest))
                    number, size = number + 1, size + len(record)
                    if size >= archive_bytes:
                        close()
                        out = None
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1], pa.int64()), part.column("page_id"),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4])], names=schema.names)
        if out is not None:
            close()

    return written(src.mapInArrow(run, schema), "warc-records")


def revisits(listing: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``listing`` with (to_archive, to_record, to_page), the record with the
    largest page_id of those with the same payload; null where the record is
    that one itself or its payload is shorter than ``min_bytes``."""
    listing = listing.withColumn("_key", F.when(F.col("payload_bytes") >= min_bytes, F.col("digest")))
    groups = (listing.where("_key is not null").groupBy("_key")
              .agg(F.max(F.struct("page_id", "archive", "record")).alias("to"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1"))
    groups = written(groups, "warc-groups")
    total = listing.count()
    hot = groups.where(F.col("copies") * HOT_SHARE > total).drop("copies")  # fewer than HOT_SHARE rows
    rest = groups.where(F.col("copies") * HOT_SHARE <= total).drop("copies").withColumnRenamed("to", "_rest")
    joined = listing.join(F.broadcast(hot), "_key", "left").withColumn("_cold", F.when(F.col("to").isNull(), F.col("_key")))
    # a null key matches nothing; it is spread, so records without an equal do not meet in one task
    joined = joined.withColumn("_cold", F.coalesce("_cold", F.concat_ws("#", "archive", "record")))
    joined = joined.join(rest.withColumnRenamed("_key", "_cold"), "_cold", "left")
    to = F.coalesce("to", "_rest")
    kept = (to["archive"] == F.col("archive")) & (to["record"] == F.col("record"))
    other = F.when(~kept, to)
    return joined.select("archive", "record", "page_id", "payload_bytes", "digest", other["archive"].alias("to_archive"),
                         other["record"].alias("to_record"), other["page_id"].alias("to_page"))


ARCHIVES = T.StructType([T.StructField("archive", T.StringType()), T.StructField("index", T.StringType()),
                         T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])


def _dealt(df: DataFrame, archives: int) -> DataFrame:
    """Rows dealt by archive, about one archive a task (no fewer tasks than
    the executors can use, at most a few a shuffle partition)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(archives, max(64, 4 * parts))), "archive")


def normalise(listing: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite the archives of ``listing`` (see ``revisits``) record by record
    into ``folder``; a table (archive, index, records, bytes)."""
    spark = listing.sparkSession
    folder = _uri(folder or scratch_path(spark, "warc-members"))
    rows = _dealt(listing.select("archive", "record", "to_archive", "to_record", F.col("to_page").cast("string").alias("to_page")),
                  listing.select("archive").distinct().count()).sortWithinPartitions("archive", "record")

    def rewritten(fields: dict, block: bytes, to) -> bytes:
        if to is None:
            return record_bytes(list(fields.items()), block)
        archive, number, page = to
        head = block[:block.index(b"\r\n\r\n") + 4]
        more = {"WARC-Type": "revisit", "WARC-Profile": PROFILE,
                "WARC-Refers-To": record_id(archive.rsplit("/", 1)[1], number)}
        if page is not None:
            more["X-Refers-To-Page-Id"] = quote(page, safe="")
        return record_bytes(list((fields | more).items()), head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, base = _open(folder)
        attempt = uuid.uuid4().hex
        now = source = members = index = stream = None
        target, at, number, done = "", 0, 0, []

        def close():
            if next(stream, None) is not None:
                raise ValueError(f"{now}: more records than listed")
            for f in (source, members, index):
                f.close()
            done.append((target, f"{target}.idx", number, at))

        for batch in batches:
            for archive, record, to_archive, to_record, to_page in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != now:
                    if now is not None:
                        close()
                    fs, path = _open(archive)
                    out_fs.create_dir(base, recursive=True)
                    source = fs.open_input_stream(path, compression=None)
                    name = f"{archive.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{attempt}.warc.gz"
                    members = out_fs.open_output_stream(f"{base}/{name}", compression=None)
                    index = out_fs.open_output_stream(f"{base}/{name}.idx", compression=None)
                    now, target, at, number, stream = archive, f"{folder}/{name}", 0, 0, records(_Stream(source))
                fields, block = next(stream)
                if record != number:
                    raise ValueError(f"{archive}: record {record} listed, {number} found")
                packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                member = packer.compress(rewritten(fields, block, None if to_archive is None else (to_archive, to_record, to_page))) + packer.flush()
                members.write(member)
                index.write(f"{at} {len(member)} {fields['WARC-Record-ID']} {'response' if to_archive is None else 'revisit'} "
                            f"{fields['WARC-Payload-Digest']}\n".encode())
                at, number = at + len(member), number + 1
        if now is not None:
            close()
        cols = list(zip(*done)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                         names=ARCHIVES.names)

    return written(rows.mapInArrow(run, ARCHIVES), "warc-archives")


def read_member(source, offset: int, length: int) -> tuple[dict, bytes]:
    """(header fields, block) of the record at an index entry."""
    source.seek(offset)
    raw = zlib.decompress(source.read(length), GZIP)
    at = raw.index(b"\r\n\r\n") + 4
    fields = dict(_fields(raw[:at]))
    n = int(fields.pop("Content-Length"))
    if raw[at + n:] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    return fields, raw[at:at + n]


def read_archives(archives: DataFrame, id_type: T.DataType = T.LongType(), with_payload: bool = True) -> DataFrame:
    """One row a record of normalised archives, found by their indexes:
    page_id, url, record_type, refers_to, payload_bytes, payload_digest and the
    payload (null for a revisit).  Stored payloads are checked against their
    digest."""
    text = [("page_id", T.StringType()), ("url", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.StringType()),
            ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("payload", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in text if with_payload or f[0] != "payload"])
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][:len(schema)]

    def one(fields: dict, block: bytes) -> tuple:
        at = block.index(b"\r\n\r\n") + 4
        head, body = block[:at].decode(), block[at:]
        size = int(head.split("\r\nContent-Length: ", 1)[1].split("\r\n", 1)[0])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        stored = fields["WARC-Type"] == "response"
        if stored and (len(body) != size or digest_of(body) != digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        return (fields.get("X-Page-Id"), fields["WARC-Target-URI"], fields["WARC-Type"],
                fields.get("X-Refers-To-Page-Id"), size, digest, body if stored else None)[:len(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

        for batch in batches:
            for archive, index in zip(*(batch.column(c).to_pylist() for c in ("archive", "index"))):
                fs, path = _open(archive)
                rows, held = [], 0
                with fs.open_input_stream(_open(index)[1], compression=None) as f:
                    entries = f.read().decode().splitlines()  # a line of about 130 bytes a record of one archive
                with fs.open_input_file(path) as source:
                    for entry in entries:
                        offset, length = map(int, entry.split(" ", 2)[:2])
                        rows.append(one(*read_member(source, offset, length)))
                        held += rows[-1][4] if with_payload else 100
                        if held > CHUNK:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    found = _dealt(archives, archives.count()).select("archive", "index").mapInArrow(run, schema)
    own = [F.expr("url_decode(replace(%s, '+', '%%2B'))" % c).cast(id_type).alias(c) for c in ("page_id", "refers_to")]
    return found.select(own[0], "url", "record_type", own[1], *schema.names[4:])


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages to normalised archives: monolithic files, revisits, members and
    indexes; the table of archives (see ``read_archives``)."""
    return normalise(revisits(write_monolithic(pages, f"{folder}/crawl" if folder else None), min_bytes),
                     f"{folder}/members" if folder else None)
