"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

``write_archives`` writes one archive per partition, each a single gzip stream
over all its records.  ``normalise`` inflates such a file once, as a stream,
rewrites every record as a gzip member of its own and writes a sidecar index
with the offset and length of each member.  Records that a table of revisits
names are rewritten as ``revisit`` records: the payload is left out, the HTTP
head with its length and the digest stay.  ``read_records`` fetches members by
the index alone.

All files go to the shared folder through its own file system (local, HDFS or
an object store).  A task writes under a name of its own attempt and then moves
the file to its final name, so a repeated task leaves the same archive.

Memory holds one record at a time.  Defined cases: a null payload is empty;
null URLs are empty; repeated rows are records of their own; an empty table
writes no archive; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import shared_dir, small_batches, stored

MIN_PAYLOAD = 100
#: Compression of the monolithic stream and of the members.
STREAM_LEVEL, MEMBER_LEVEL = 1, 2
CHUNK = 1 << 18

# Record framing of WARC/1.1.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(path: str) -> str:
    """``file:/x`` as ``file:///x``."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


class _Output:
    """A file that appears under its name only when complete."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = _file_system(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.file = self.fs.open_output_stream(self.temp)
        self.write = self.file.write

    def commit(self) -> None:
        self.file.close()
        self.fs.move(self.temp, self.path)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The HTTP body of a response."""
        return self.block.partition(END)[2]

    @property
    def http(self) -> dict[str, str]:
        lines = self.block.partition(END)[0].decode("utf-8", "surrogateescape").split("\r\n")[1:]
        return dict(x.split(": ", 1) for x in lines)

    def encoded(self) -> bytes:
        head = "\r\n".join([VERSION.decode(), *(f"{k}: {v}" for k, v in self.headers.items())])
        return head.encode("utf-8", "surrogateescape") + END + self.block + END


def response(page_id: int | None, url: str | None, payload: bytes) -> Record:
    digest = hashlib.sha256(payload).hexdigest()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Length": str(len(block)),
    }
    return Record(headers, block)


def revisit(record: Record, refers_to: int) -> Record:
    """``record`` without its payload, pointing at the page that has it."""
    block = record.block.partition(END)[0] + END
    headers = record.headers | {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    return Record(headers | {"Content-Length": str(len(block))}, block)


class _Stream:
    """Sequential reading of inflated bytes from chunks, with bounded look-ahead."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.buffer = chunks, bytearray()

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is None:
            return False
        self.buffer += chunk
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is consumed; None at the end."""
        at = 0
        while (found := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer:
                    raise ValueError("an archive ends inside a record head")
                return None
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def inflate(source) -> Iterator[bytes]:
    """Inflated chunks of a gzip file, one member or many, each of at most CHUNK * 4 bytes."""
    machine = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            out = machine.decompress(data, CHUNK * 4)
            if out:
                yield out
            data = machine.unconsumed_tail
            if machine.eof:
                data, machine = machine.unused_data, zlib.decompressobj(31)


def records(chunks: Iterator[bytes]) -> Iterator[Record]:
    stream = _Stream(chunks)
    while (head := stream.until(END)) is not None:
        lines = head.decode("utf-8", "surrogateescape").split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError("no WARC record where one should start")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        block = stream.exactly(int(headers["Content-Length"]))
        if stream.exactly(len(END)) != END:
            raise ValueError("a WARC record does not end where its length says")
        yield Record(headers, block)


def _page_of(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write ``<path>/<partition>.warc.gz``, one gzip stream each; returns (archive, ordinal, page_id, payload_bytes, payload_digest)."""
    small_batches(pages.sparkSession)
    path = _uri(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{path}/{TaskContext.get().partitionId():06d}.warc.gz"
        out, machine, ordinal = None, zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, 31), 0
        for batch in batches:
            rows: list[tuple] = []
            for page_id, url, body in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or _Output(name)
                payload = (body or "").encode("utf-8", "surrogatepass")
                record = response(page_id, url, payload)
                out.write(machine.compress(record.encoded()))
                rows.append((name, ordinal, page_id, len(payload), record.headers["WARC-Payload-Digest"].removeprefix("sha256:")))
                ordinal += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["archive", "ordinal", "page_id", "payload_bytes", "payload_digest"])
        if out:
            out.write(machine.flush())
            out.commit()

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(body_col).cast("string"))
    # the manifest is stored: reading it again must not write the archives again
    return stored(rows.mapInArrow(run, "archive string, ordinal long, page_id long, payload_bytes long, payload_digest string"), "manifest")


def revisits(manifest: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(archive, ordinal, refers_to) of records whose payload a record of a smaller page id has.

    Of the records of one payload that share the smallest id, the first in
    archive order is the response.
    """
    big = manifest.filter((F.col("payload_bytes") >= min_payload) & F.col("page_id").isNotNull())
    first = big.groupBy("payload_digest").agg(F.min(F.struct("page_id", "archive", "ordinal")).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    pairs = big.join(first, "payload_digest").filter(~((F.col("archive") == F.col("first.archive")) & (F.col("ordinal") == F.col("first.ordinal"))))
    return pairs.select("archive", "ordinal", F.col("first.page_id").alias("refers_to"))


def normalise(archives: DataFrame, path: str) -> DataFrame:
    """Rewrite archives record by record under ``path``.

    ``archives`` has (archive, changes), an array of (ordinal, refers_to) of the
    records to turn into revisits.  Beside each new archive lies
    ``<name>.index.jsonl``, one line per member.  Returns (archive, index).
    """
    spark = archives.sparkSession
    small_batches(spark)
    path = _uri(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, changes in zip(*(c.to_pylist() for c in batch.columns)):
                turned = {c["ordinal"]: c["refers_to"] for c in changes or ()}
                name = f"{path}/{archive.rsplit('/', 1)[1]}"
                files, place = _file_system(archive)
                out, index, offset = _Output(name), _Output(f"{name}.index.jsonl"), 0
                with files.open_input_stream(place, compression=None) as source:
                    for ordinal, record in enumerate(records(inflate(source))):
                        if ordinal in turned:
                            record = revisit(record, turned[ordinal])
                        machine = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
                        member = machine.compress(record.encoded()) + machine.flush()
                        out.write(member)
                        entry = {"offset": offset, "length": len(member), "type": record.headers["WARC-Type"], "url": record.headers["WARC-Target-URI"], "id": record.headers["WARC-Record-ID"]}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset += len(member)
                out.commit()
                index.commit()
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([f"{name}.index.jsonl"])], ["archive", "index"])

    return stored(archives.select("archive", "changes").mapInArrow(run, "archive string, index string"), "normalised")


def read_index(spark, index_paths: DataFrame) -> DataFrame:
    """(archive, offset, length, type, url, id): the lines of sidecar indexes named in column ``index``."""
    folders = sorted({r.folder for r in index_paths.select(F.regexp_extract("index", r"^(.*)/[^/]*$", 1).alias("folder")).distinct().collect()})
    if not folders:
        return spark.createDataFrame([], "archive string, offset long, length long, type string, url string, id string")
    lines = spark.read.schema("offset long, length long, type string, url string, id string").option("pathGlobFilter", "*.index.jsonl").json(folders)
    archive = F.regexp_replace(F.input_file_name(), r"\.index\.jsonl$", "")
    return lines.select(archive.alias("archive"), "offset", "length", "type", "url", "id")


def read_records(index: DataFrame) -> DataFrame:
    """Fetch each member by its index entry: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A response's payload is measured and its digest checked; a revisit's length
    and digest come from its record.
    """
    small_batches(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, source = None, None
        for batch in batches:
            rows: list[tuple] = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != open_name:
                    files, place = _file_system(_uri(archive))
                    open_name, source = archive, files.open_input_file(place)
                source.seek(offset)
                data = zlib.decompress(source.read(length), 31)
                (record,) = records(iter([data]))
                kind, digest = record.headers["WARC-Type"], record.headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response":
                    payload = record.payload
                    size = len(payload)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged payload in {archive} at {offset}")
                    refers = None
                else:
                    size, refers = int(record.http["Content-Length"]), _page_of(record.headers["WARC-Refers-To"])
                rows.append((_page_of(record.headers["WARC-Record-ID"]), size, digest, kind, refers))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return index.select("archive", "offset", "length").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, path: str | None = None, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write pages as monolithic archives, normalise them with revisits, and read all records back by index."""
    path = path or shared_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, f"{path}/monolithic")
    # an archive's changes are at most its own records; archives without any still get rewritten
    changes = revisits(manifest, min_payload).groupBy("archive").agg(F.collect_list(F.struct("ordinal", "refers_to")).alias("changes"))
    names = stored(manifest.select("archive").distinct(), "archive-names")
    archives = names.count()
    # a task for each archive: ranges of the names as they are sorted, since hashes of few names fall together
    dealt = names.join(changes, "archive", "left").repartitionByRange(max(1, archives), "archive")
    done = normalise(dealt, f"{path}/records")
    return read_records(read_index(pages.sparkSession, done))
