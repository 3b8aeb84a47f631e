"""A Spark data source that reads what can be read and says what became of every file.

Text files (CSV, TSV, JSON lines; plain, gzip or bzip2) and Parquet files are read as streams, in tasks that share out the
files by size. Each file gives its accepted records, its rejected ones, and last of all a status row, so a file that
breaks in the middle counts with what came before the break, and none is lost. Listing, opening and reading use
``pyarrow.fs``: local paths, ``hdfs:``, ``viewfs:``, ``s3:`` and ``gs:``.
"""

from __future__ import annotations

import bz2
import csv
import fnmatch
import json
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "resilient_files"
#: What follows the declared columns in every row. ``status`` is set in a file's last row alone.
TAIL = [
    T.StructField("input_file", T.StringType()), T.StructField("record", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("accepted", T.LongType()),
    T.StructField("rejected", T.LongType()), T.StructField("error", T.StringType()),
]
READ, DAMAGED, NO_RECORD, NO_COLUMN = "read", "damaged", "no record", "no column"
#: Bytes of files per task, and rows per batch.
TASK_BYTES, BATCH_ROWS = 64 << 20, 5000
_KINDS = {"csv": "csv", "tsv": "tsv", "json": "json", "jsonl": "json", "parquet": "parquet"}


def _kind(path: str, asked: str) -> str:
    """The format asked for, or by the file's name; files with other names are read as CSV."""
    if asked != "auto":
        return asked
    name = re.sub(r"\.(gz|bz2)$", "", path.lower())
    return _KINDS.get(name.rpartition(".")[2], "csv")


def _open(path: str):
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:/", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)


def list_files(path: str) -> list[tuple[str, int]]:
    """Path and size of the files that a path, a folder (with all below it) or a glob names, in order.

    Names that begin with ``_`` or ``.`` are left out, unless asked for by name.
    """
    from pyarrow import fs

    system, root = _open(path)
    local = isinstance(system, fs.LocalFileSystem)
    prefix = "file:" if local else path[: len(path) - len(root)]  # names keep the store that was asked for
    if not re.search(r"[*?\[]", root):
        info = system.get_file_info(root)
        if info.type == fs.FileType.File:
            return [(prefix + info.path, info.size)]
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        pattern, base = None, root.rstrip("/")
    else:
        base = re.split(r"[*?\[]", root)[0].rpartition("/")[0]
        found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        pattern = [re.compile(fnmatch.translate(part)) for part in root.rstrip("/").split("/")]

    def wanted(name: str) -> bool:
        parts = name.split("/")
        if any(p[:1] in "_." for p in name[len(base) :].split("/") if p):
            return False
        # a glob may name files, or folders with files below them
        return not pattern or len(parts) >= len(pattern) and all(p.match(x) for p, x in zip(pattern, parts))

    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and wanted(f.path))


class _Broken:
    """The error that ended a file, if any, and what was left of its last record."""

    def __init__(self):
        self.error: str | None = None
        self.rest = ""


def _raw(stream, path: str) -> Iterator[bytes]:
    while block := stream.read(1 << 20):
        yield block


def _decompressed(blocks: Iterator[bytes], path: str) -> Iterator[bytes]:
    """Plain bytes, as far as they go; ``EOFError`` where a compressed file ends too early."""
    if path.endswith(".gz"):
        new = lambda: zlib.decompressobj(wbits=31)
    elif path.endswith(".bz2"):
        new = bz2.BZ2Decompressor
    else:
        yield from blocks
        return
    codec, open_ = new(), False
    for block in blocks:
        while block:
            if codec.eof:  # files may hold several parts one after the other
                codec = new()
            open_ = True
            yield codec.decompress(block)
            block = codec.unused_data if codec.eof else b""
    if open_ and not codec.eof:
        raise EOFError("compressed data ends early")


def _lines(blocks: Iterator[bytes], broken: _Broken) -> Iterator[str]:
    """Lines with their ends. A last line that a break may have cut is no line, but goes to ``broken``."""
    rest = b""
    try:
        for block in blocks:
            *lines, rest = (rest + block).split(b"\n") if b"\n" in block else (rest + block,)
            for line in lines:
                yield line.decode("utf-8", "surrogateescape") + "\n"
    except Exception as e:  # whatever a damaged file or a failing store raises belongs in its status
        broken.error, broken.rest = f"{type(e).__name__}: {e}", rest.decode("utf-8", "replace")
        return
    if rest:
        yield rest.decode("utf-8", "surrogateescape")


def _valid(value: str) -> bool:
    try:
        value.encode()
    except UnicodeEncodeError:
        return False
    return True


@dataclass
class _Part(InputPartition):
    files: list[tuple[str, str]]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.asked = options["path"], options.get("kind", "auto")
        self.columns = json.loads(options["columns"])
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        kinds = [(c, pa.string()) for c in self.columns]
        kinds += [(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in TAIL]
        self.schema = pa.schema(kinds)

    def partitions(self) -> list[InputPartition]:
        parts, own, size = [], [], 0
        for path in json.loads(self.path):
            for name, n in list_files(path):
                own.append((name, _kind(name, self.asked)))
                size += n
                if size >= self.task_bytes:
                    parts.append(_Part(own))
                    own, size = [], 0
        return [*parts, _Part(own)] if own or not parts else parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for path, kind in partition.files:
            yield from self._file(path, kind)

    def _batch(self, path: str, rows: list[list], rejected: list[str]) -> pa.RecordBatch:
        n, m = len(rows), len(rejected)
        columns = [pa.array([*[r[i] for r in rows], *[None] * m], pa.string()) for i in range(len(self.columns))]
        columns += [pa.array([path] * (n + m)), pa.array([None] * n + rejected, pa.string())]
        columns += [pa.nulls(n + m, self.schema.field(i).type) for i in range(len(columns), len(self.schema))]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def _file(self, path: str, kind: str) -> Iterator[pa.RecordBatch]:
        broken, rows, rejected = _Broken(), [], []
        n = m = 0
        status = NO_RECORD
        try:
            if kind == "parquet":
                for batch in self._parquet(path):
                    n += batch.num_rows
                    yield batch
            for record, raw in self._text(path, kind, broken) if kind != "parquet" else ():
                if record is None:
                    rejected.append(raw.encode("utf-8", "replace").decode())
                    m += 1
                else:
                    rows.append(record)
                    n += 1
                if len(rows) + len(rejected) >= BATCH_ROWS:
                    yield self._batch(path, rows, rejected)
                    rows, rejected = [], []
            status = READ if n + m else NO_RECORD
        except LookupError as e:
            status, broken.error = NO_COLUMN, f"no column {e}"
        except Exception as e:  # as above: the status says it
            broken.error = f"{type(e).__name__}: {e}"
        if broken.error and status != NO_COLUMN:
            status = DAMAGED
            if broken.rest:
                rejected.append(broken.rest)
                m += 1
        if rows or rejected:
            yield self._batch(path, rows, rejected)
        last = {"input_file": path, "status": status, "accepted": n, "rejected": m, "error": broken.error}
        yield pa.RecordBatch.from_pylist([last], self.schema)

    def _parquet(self, path: str) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        system, name = _open(path)
        with system.open_input_file(name) as stream:
            file = pq.ParquetFile(stream)
            if missing := [c for c in self.columns if c not in file.schema_arrow.names]:
                raise LookupError(missing[0])
            for batch in file.iter_batches(BATCH_ROWS, columns=self.columns):
                columns = [batch.column(c).cast(pa.string()) for c in self.columns]
                columns.append(pa.array([path] * batch.num_rows))
                columns += [pa.nulls(batch.num_rows, f.type) for f in list(self.schema)[len(columns) :]]
                yield pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def _text(self, path: str, kind: str, broken: _Broken) -> Iterator[tuple[list | None, str]]:
        system, name = _open(path)
        with system.open_input_stream(name, compression=None) as stream:
            lines = _lines(_decompressed(_raw(stream, path), path), broken)
            yield from self._json(lines) if kind == "json" else self._csv(lines, "\t" if kind == "tsv" else ",", broken)

    def _json(self, lines: Iterator[str]) -> Iterator[tuple[list | None, str]]:
        for line in lines:
            if not line.strip():
                continue
            try:
                found = json.loads(line)
                values = [found.get(c) for c in self.columns]
            except (ValueError, AttributeError):
                yield None, line.rstrip("\r\n")
                continue
            values = [v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values]
            ok = all(v is None or _valid(v) for v in values)
            yield (values, "") if ok else (None, line.rstrip("\r\n"))

    def _csv(self, lines: Iterator[str], separator: str, broken: _Broken) -> Iterator[tuple[list | None, str]]:
        seen: list[str] = []
        ended = False

        def noted() -> Iterator[str]:
            nonlocal ended
            for line in lines:
                seen.append(line)
                yield line
            ended = True  # asked for within a record: its quote was never closed

        reader = csv.reader(noted(), delimiter=separator)
        header = None
        while True:
            seen.clear()
            try:
                fields = next(reader, None)
            except csv.Error:
                yield None, "".join(seen).rstrip("\r\n")
                continue
            if fields is None:
                return
            if not fields:  # an empty line
                continue
            if header is None:
                header = [h.lstrip("﻿") for h in fields]
                if missing := [c for c in self.columns if c not in header]:
                    raise LookupError(missing[0])
                places = [header.index(c) for c in self.columns]
                continue
            if ended or len(fields) != len(header) or not all(map(_valid, fields)):
                yield None, "".join(seen).rstrip("\r\n")
            else:
                yield [fields[i] or None for i in places], ""


class ResilientFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        columns = [T.StructField(c, T.StringType()) for c in json.loads(self.options["columns"])]
        return T.StructType([*columns, *TAIL])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_files(
    spark: SparkSession, path: str | list[str], columns: list[str], kind: str = "auto", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Records, rejected records and status rows of all files: the declared columns as strings (an empty CSV field is
    null), found by name in a file's header, and the columns of ``TAIL``. ``kind``: ``csv``, ``tsv``, ``json`` (a
    record per line), ``parquet``, or ``auto`` for each file by its name."""
    spark.dataSource.register(ResilientFiles)
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format(FORMAT).option("columns", json.dumps(columns)).option("kind", kind)
    return reader.option("task_bytes", str(task_bytes)).load(json.dumps(paths))
