"""Web archives as a Python data source of Spark: files are read in byte ranges, record by record, and written.

A range of a gzip file begins at the first member at or behind its start that holds a record, and ends with the member that
begins before its end, so ranges of one file share no record and miss none. A broken member becomes a row with an error,
and reading goes on at the next one.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, StringContains, WriterCommitMessage

SCHEMA = "warc_path string, record_type string, url string, warc_date string, mime string, body binary, html string, offset long, error string"
WRITTEN = "url string, html string"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [{"binary": pa.binary(), "long": pa.int64()}.get(c.split()[1], pa.string()) for c in SCHEMA.split(", ")]
#: Bytes of a file that a task reads by default, that are read at once, and rows and bytes of a batch.
RANGE, _CHUNK, _BATCH, _BATCH_BYTES = 64 << 20, 1 << 18, 256, 16 << 20
_MAGIC = b"\x1f\x8b\x08"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, of a URI or a local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class BrokenRecord(ValueError):
    pass


# ---- records -------------------------------------------------------------------------------------------------------
def _headers(stream) -> dict[str, str] | None:
    """Header lines to the next blank one, by lower-cased name; the first line is ''. None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    out = {"": line.decode("utf-8", "replace").strip()}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if size == 0:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out) or body


def _unpacked(body: bytes, coding: str) -> bytes:
    try:
        return gzip.decompress(body) if coding in ("gzip", "x-gzip") else zlib.decompress(body) if coding == "deflate" else body
    except (OSError, EOFError, zlib.error):
        return body


def _skip(stream, size: int) -> int:
    left = size
    while left and (part := stream.read(min(left, _CHUNK))):
        left -= len(part)
    return size - left


def records(stream, types: frozenset[str] | None = None, mime: str = "") -> Iterator[tuple[str, str, str, str, bytes]]:
    """(type, url, date, mime, body) of the records of a stream; of other types, or without mime in theirs, bodies are not kept."""
    while (head := _headers(stream)) is not None:
        if not head[""].startswith("WARC/"):
            raise BrokenRecord(f"not a web archive record: {head['']!r}"[:200])
        try:
            size = int(head.get("content-length", 0))
        except ValueError:
            raise BrokenRecord(f"no length: {head['content-length']!r}"[:200]) from None
        kind, media = head.get("warc-type", ""), head.get("content-type", "")
        if types is not None and kind not in types:
            if _skip(stream, size) < size:
                raise BrokenRecord("the record ends early")
            continue
        body = stream.read(size)
        if len(body) < size:
            raise BrokenRecord("the record ends early")
        if kind == "response" and media.lower().startswith("application/http"):
            inner = io.BytesIO(body)
            http = _headers(inner) or {}
            media = http.get("content-type", "")
            if mime in media.lower():
                body = inner.read()
                if "chunked" in http.get("transfer-encoding", "").lower():
                    body = _dechunk(body)
                body = _unpacked(body, http.get("content-encoding", "").lower())
        if mime in media.lower():
            yield kind, head.get("warc-target-uri", ""), head.get("warc-date", ""), media, body


class _Member(io.RawIOBase):
    """The contents of the gzip member at the place of file; end is where the next one begins, once this is read."""

    def __init__(self, file, at: int):
        self.file, self.at, self.taken, self.waiting, self.end = file, at, 0, b"", None
        self.unpack = zlib.decompressobj(31)
        file.seek(at)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.unpack.eof:
            data = self.waiting or self.file.read(_CHUNK)
            if not self.waiting:
                self.taken += len(data)
            if not data:
                raise BrokenRecord("the member ends early")
            out = self.unpack.decompress(data, len(into))
            self.waiting = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.end = self.at + self.taken - len(self.unpack.unused_data)
            if out:
                into[: len(out)] = out
                return len(out)
        return 0


def _begins(file, at: int) -> bool:
    """True if a member that holds a record begins at that place."""
    file.seek(at)
    try:
        return zlib.decompressobj(31).decompress(file.read(4096), 5) == b"WARC/"
    except zlib.error:
        return False


def next_member(file, at: int, end: int) -> int:
    """The first place in [at, end) at which a member with a record begins; end if there is none."""
    while at < end:
        file.seek(at)
        block = file.read(min(_CHUNK, end - at) + 2)
        found = block.find(_MAGIC)
        while found >= 0:
            if at + found < end and _begins(file, at + found):
                return at + found
            found = block.find(_MAGIC, found + 1)
        at += _CHUNK
    return end


def ranged(file, start: int, end: int, types: frozenset[str] | None = None, mime: str = "") -> Iterator[tuple[int, str | None, tuple | None]]:
    """(offset of the member, error, record) of the members of a file that begin in [start, end); one of both is None.

    A file that isn't gzip is one range, [0, end).
    """
    file.seek(0)
    if file.read(2) != _MAGIC[:2]:
        file.seek(0)
        if start == 0:
            try:
                for record in records(io.BufferedReader(file, _CHUNK), types, mime):
                    yield 0, None, record
            except BrokenRecord as error:
                yield 0, str(error), None
        return
    at = 0 if start == 0 else next_member(file, start, end)
    while at < end:
        member = _Member(file, at)
        try:
            stream = io.BufferedReader(member, _CHUNK)
            for record in records(stream, types, mime):
                yield at, None, record
                file.seek(at + member.taken)  # whoever consumes may have moved it
            following = member.end
        except (BrokenRecord, zlib.error) as error:
            yield at, str(error), None
            following = next_member(file, at + 1, end)
        at = following if following is not None else end
        file.seek(at)
        if at < end and file.read(3) != _MAGIC:  # padding between members
            at = next_member(file, at, end)


# ---- reading -------------------------------------------------------------------------------------------------------
@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    """types, mime: what is kept, by the options recordTypes and mime."""

    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("rangebytes", RANGE))
        self.files = int(options["numfiles"]) if options.get("numfiles") else None
        kinds = options.get("recordtypes", "")
        self.types = frozenset(k.strip() for k in kinds.split(",") if k.strip()) or None
        self.mime = options.get("mime", "").lower()
        if self.range < 1:
            raise ValueError("rangeBytes must be positive")

    def _listed(self) -> list[tuple[str, int]]:
        system, path = opened(self.path)
        about = system.get_file_info(path)
        if about.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        infos = [about] if about.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda p: any(part[:1] in "._" for part in p[len(path) :].split("/") if part)
        found = sorted((i.path, i.size) for i in infos if i.is_file and i.path.endswith((".warc", ".warc.gz")) and (about.is_file or not hidden(i.path)))
        return found[: self.files]

    def partitions(self) -> list[FileRange]:
        """Ranges of all files; a file that isn't compressed is one, as its records can't be told from their contents."""
        out = []
        for path, size in self._listed():
            step = self.range if path.endswith(".gz") else max(size, 1)
            out += [FileRange(path, at, min(at + step, size)) for at in range(0, size, step)]
        return out or [FileRange("", 0, 0)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = opened(self.path)
        name, rows, size = partition.path.rsplit("/", 1)[-1], [], 0
        with system.open_input_file(partition.path) as file:
            for offset, error, record in ranged(file, partition.start, partition.end, self.types, self.mime):
                body = record[4] if record else None
                rows.append((name, *(record or (None,) * 5), None if body is None else body.decode("utf-8", "ignore"), offset, error))
                size += 2 * len(body or b"")
                if len(rows) >= _BATCH or size >= _BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


class PushingReader(WarcReader):
    """The reader of a session that lets filters be pushed into Python sources."""

    def pushFilters(self, filters):
        """Of the filters, record_type = or IN, and what mime contains, choose records here; Spark applies all of them again."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("record_type",):
                own = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                self.types = own if self.types is None else self.types & own
            elif isinstance(f, StringContains) and f.attribute == ("mime",) and not self.mime:
                self.mime = f.value.lower()
            yield f


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


# ---- writing -------------------------------------------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    path: str | None


class WarcWriter(DataSourceWriter):
    """Rows (url, html) as response records, a gzip member each. Files appear under their names when all tasks are done."""

    def __init__(self, options: dict, names: list[str], overwrite: bool):
        self.path, self.date = options["path"].rstrip("/"), options.get("warcdate", "1970-01-01T00:00:00Z")
        missing = {"url", "html"} - set(names)
        if missing:
            raise ValueError(f"a web archive needs the columns {sorted(missing)}")
        system, path = opened(self.path)
        self.run = uuid4().hex
        if overwrite and system.get_file_info(path).type != fs.FileType.NotFound:
            system.delete_dir_contents(path)
        system.create_dir(f"{path}/_{self.run}", recursive=True)

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        system, path = opened(self.path)
        about = TaskContext.get()
        name = f"{path}/_{self.run}/part-{about.partitionId():05d}-{about.taskAttemptId()}.warc.gz"
        out = None
        for row in iterator:
            out = out or system.open_output_stream(name, compression=None)
            http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (row["html"] or "").encode()
            head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{uuid4()}>\r\nWARC-Target-URI: {row['url'] or ''}\r\nWARC-Date: {self.date}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
            out.write(gzip.compress(head.encode() + http + b"\r\n\r\n", mtime=0))
        if out:
            out.close()
        return Written(name if out else None)

    def commit(self, messages) -> None:
        system, path = opened(self.path)
        for m in messages:
            if m and m.path:
                system.move(m.path, f"{path}/{m.path.rsplit('/', 1)[-1]}")
        system.delete_dir(f"{path}/_{self.run}")

    def abort(self, messages) -> None:
        system, path = opened(self.path)
        system.delete_dir(f"{path}/_{self.run}")


class WarcDataSource(DataSource):
    """format("warc") of options path, recordTypes, mime, rangeBytes, numFiles, pushFilters; to write, warcDate."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (PushingReader if options.get("pushfilters", "").lower() == "true" else WarcReader)(options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, schema.names, overwrite)


def read_warc(spark: SparkSession, path: str, num_files: int | None = None, record_types: str = "", mime: str = "", range_bytes: int = RANGE) -> DataFrame:
    """Rows of SCHEMA for every record of the *.warc and *.warc.gz files below path (files whose names begin with . or _ not).

    path is a local one that all machines share, or a URI of a store that Arrow reaches. What can't be read is a row
    with an error and null elsewhere but for warc_path and offset. Filters on record_type and mime choose records in the
    reader where spark.sql.python.filterPushdown.enabled is set.
    """
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("recordTypes", record_types).option("mime", mime).option("rangeBytes", range_bytes)
    reader = reader.option("pushFilters", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    return (reader.option("numFiles", num_files) if num_files else reader).load(path)


def write_warc(pages: DataFrame, path: str, mode: str = "append") -> None:
    """pages (url, html) as gzip archives below path, a file for each partition that has rows."""
    pages.sparkSession.dataSource.register(WarcDataSource)
    pages.select("url", "html").write.format("warc").mode(mode).save(path)
