"""MCAP logs as a Spark data source: records with schemas and channels, read message by message and written in two phases.

    spark.dataSource.register(McapSource)
    spark.read.format("mcap").load(folder)                                  # all columns
    spark.read.format("mcap").schema("topic string, log_time long").load(folder)  # payloads aren't kept
    rows.repartition("log").sortWithinPartitions("log", "log_time").write.format("mcap").mode("append").save(folder)

Reading takes a file per partition and holds one record (or one chunk) at a time; with the
option `pushdown`, equality and ranges on topic and log_time are applied before a row is made.  A log that ends before
its footer is refused.  Writing stages files beside the target; they take their names when
all tasks are done, and go when one fails.  A log has to come from one task.  Paths are those
of any file system that Arrow opens by its address.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

# Fixed values of the format.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, DATA_END = 0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0F

READ_SCHEMA = "path string, topic string, schema string, encoding string, sequence long, log_time long, publish_time long, data binary"
#: Messages of an Arrow batch.
BATCH = 4096


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Fields:
    """Reads the fields of a record one after the other."""

    def __init__(self, body: bytes):
        self.body, self.at = body, 0

    def number(self, kind: str) -> int:
        (n,) = struct.unpack_from("<" + kind, self.body, self.at)
        self.at += struct.calcsize("<" + kind)
        return n

    def raw(self, size: int | None = None) -> bytes:
        n = len(self.body) - self.at if size is None else size
        if self.at + n > len(self.body):
            raise ValueError("a field runs past its record")
        self.at += n
        return self.body[self.at - n : self.at]

    def text(self) -> str:
        return self.raw(self.number("I")).decode()


def field(*values: int | str | bytes | dict) -> bytes:
    """Bytes of fields: (kind, number) pairs are given as 'kind', number; texts, bytes and maps with their length."""
    out, it = b"", iter(values)
    for v in it:
        if isinstance(v, str) and v.startswith("<"):
            out += struct.pack(v, next(it))
        elif isinstance(v, dict):
            inner = b"".join(field(k, x) for k, x in v.items())
            out += struct.pack("<I", len(inner)) + inner
        else:
            raw = v.encode() if isinstance(v, str) else v
            out += struct.pack("<I", len(raw)) + raw
    return out


def record(code: int, body: bytes) -> bytes:
    return struct.pack("<BQ", code, len(body)) + body


def records(stream, name: str) -> Iterator[tuple[int, bytes]]:
    """Records of a log up to its footer, those of chunks in place of the chunk."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError(f"{name} is no log: it doesn't begin as one")
    while True:
        head = stream.read(9)
        code, size = struct.unpack("<BQ", head) if len(head) == 9 else (0, 0)
        body = stream.read(size) if code else b""
        if not code or len(body) < size:
            raise ValueError(f"{name} ends within a record")
        if code == FOOTER:
            if stream.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"{name} lacks its end")
            return
        if code == CHUNK:
            yield from chunk_records(body, name)
        else:
            yield code, body


def chunk_records(body: bytes, name: str) -> Iterator[tuple[int, bytes]]:
    f = Fields(body)
    f.number("Q"), f.number("Q")
    size, _, how = f.number("Q"), f.number("I"), f.text()
    inner = f.raw(f.number("Q"))
    if how == "zstd":
        import zstandard

        inner = zstandard.ZstdDecompressor().decompress(inner, max_output_size=size)
    elif how:
        raise ValueError(f"{name} has chunks in {how}, which isn't read")
    stream = io.BytesIO(inner)
    while head := stream.read(9):
        code, n = struct.unpack("<BQ", head)
        yield code, stream.read(n)


@dataclass
class File(InputPartition):
    path: str


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.names = options["path"], schema.names
        self.topics: set[str] | None = None
        self.low, self.high = -(1 << 63), (1 << 63) - 1

    def partitions(self) -> Sequence[InputPartition]:
        fs, path = opened(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        base = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        return [File(base + f.path) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".mcap") and "/_staged-" not in f.path]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        kinds = {"sequence": pa.int64(), "log_time": pa.int64(), "publish_time": pa.int64(), "data": pa.binary()}
        fs, path = opened(partition.path)
        schemas, channels, rows = {0: ("", "")}, {}, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in self.names], self.names)

        with fs.open_input_stream(path) as stream:
            for code, body in records(stream, partition.path):
                f = Fields(body)
                if code == SCHEMA:
                    own = f.number("H")
                    schemas[own] = (f.text(), f.text())
                elif code == CHANNEL:
                    own, of = f.number("H"), f.number("H")
                    channels[own] = {"path": partition.path, "topic": f.text(), "schema": schemas[of][0], "encoding": f.text()}
                elif code == MESSAGE:
                    channel, sequence, at, published = channels[f.number("H")], f.number("I"), f.number("Q"), f.number("Q")
                    if (self.topics is None or channel["topic"] in self.topics) and self.low <= at <= self.high:
                        rows.append(channel | {"sequence": sequence, "log_time": at, "publish_time": published} | ({"data": f.raw()} if "data" in self.names else {}))
                        if len(rows) >= BATCH:
                            yield batch()
                            rows = []
        if rows:
            yield batch()


class FilteringReader(Reader):
    """Takes filters from Spark, which allows it only where `spark.sql.python.filterPushdown.enabled` is set."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            at = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if at == "topic" and isinstance(f, EqualTo | In):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.topics = own if self.topics is None else self.topics & own
            elif at == "log_time" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif at == "log_time" and isinstance(f, LessThan | LessThanOrEqual):
                self.high = min(self.high, f.value - isinstance(f, LessThan))
            else:
                yield f


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str]]  # where it is, name that it gets


class Writer(DataSourceArrowWriter):
    """Rows: log, topic, schema, log_time, data, and optionally sequence, encoding, schema_text. Rows of a log follow each other."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.names, self.job = options["path"].rstrip("/"), schema.names, uuid.uuid4().hex
        if missing := {"log", "topic", "schema", "log_time", "data"} - set(self.names):
            raise ValueError(f"logs lack the columns {sorted(missing)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, path = opened(self.path)
        stage = f"{path}/_staged-{self.job}/{uuid.uuid4().hex}"
        files, out, log = [], None, None
        channels: dict[tuple, int] = {}
        counts: dict[int, int] = {}

        def close() -> None:
            if out is not None:
                out.write(record(DATA_END, field("<I", 0)) + record(FOOTER, field("<Q", 0, "<Q", 0, "<I", 0)) + MAGIC)
                out.close()

        fs.create_dir(stage, recursive=True)
        for batch in iterator:
            rows = batch.to_pylist()
            for r in rows:
                if r["log"] != log:
                    close()
                    log = r["log"]
                    if log in {n for _, n in files}:
                        raise ValueError(f"rows of log {log} don't follow each other")
                    files.append((f"{stage}/{len(files)}.mcap", log))
                    out = fs.open_output_stream(files[-1][0])
                    channels, counts = {}, {}
                    out.write(MAGIC + record(HEADER, field("", "episodica")))
                key = (r["topic"], r["schema"], r.get("encoding") or "json")
                if key not in channels:
                    own = channels[key] = len(channels) + 1
                    out.write(record(SCHEMA, field("<H", own, key[1], "jsonschema", r.get("schema_text") or '{"type": "object"}')) + record(CHANNEL, field("<H", own, "<H", own, key[0], key[2], {"log": log})))
                own = channels[key]
                number = r.get("sequence")
                number = counts.get(own, 0) if number is None else number
                counts[own] = number + 1
                out.write(record(MESSAGE, field("<H", own, "<I", number, "<Q", r["log_time"], "<Q", r["log_time"]) + (r["data"] or b"")))
        close()
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, path = opened(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [n for _, n in files]
        taken = [n for n in set(names) if names.count(n) > 1 or fs.get_file_info(f"{path}/{n}.mcap").type != pafs.FileType.NotFound]
        if taken:
            self.abort(messages)
            raise ValueError(f"logs {sorted(taken)[:5]} came from several tasks or are there already")
        for at, name in files:
            fs.move(at, f"{path}/{name}.mcap")
        fs.delete_dir(f"{path}/_staged-{self.job}")

    def abort(self, messages: list[Staged | None]) -> None:
        fs, path = opened(self.path)
        stage = f"{path}/_staged-{self.job}"
        if fs.get_file_info(stage).type != pafs.FileType.NotFound:
            fs.delete_dir(stage)


class McapSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return (FilteringReader if self.options.get("pushdown") == "true" else Reader)(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("logs are added, none is overwritten")
        return Writer(self.options, schema)
