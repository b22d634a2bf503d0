"""Feed archives as a Spark data source (S1-S3): a partition for each (archive, member), columns from the headers.

``path`` names one zip archive or a folder of archives; the driver reads only their central directories and the first
line of the wanted members, each task streams one member (a compressed member can only be read from its beginning). A member is
found by its base name, in whatever folder of the archive it stands. Declared columns are typed, all others stay
text, columns that one archive lacks are null in its rows; nothing is dropped: a value that does not fit its type becomes null and
its record names the columns in ``_bad``, as do records that are longer or shorter than their header.

The writer makes one archive for each partition, so a table of any size is written by many tasks.
"""

from __future__ import annotations

import csv
import io
import itertools
import json
import re
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Records handed to Spark at a time, and archives whose directories are read side by side.
RECORDS, LISTERS = 10_000, 16
BAD = "_bad"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(path)


def archives(path: str) -> list[str]:
    """The archive at ``path``, or all archives below it."""
    store, inner = _store(path)
    if store.get_file_info(inner).type == fs.FileType.File:
        return [path]
    found = [f.path for f in store.get_file_info(fs.FileSelector(inner, recursive=True)) if f.is_file and f.path.lower().endswith(".zip")]
    head = path[:len(path) - len(inner)] if "://" in path and path.endswith(inner) else ""
    return sorted(head + f for f in found)


def _opened(archive: str) -> zipfile.ZipFile:
    store, inner = _store(archive)
    return zipfile.ZipFile(store.open_input_file(inner))


def members(path: str) -> list[tuple[str, str, int]]:
    """(archive, member, bytes) of every ``.txt`` member, from the central directories."""
    def one(archive):
        with _opened(archive) as z:
            return [(archive, i.filename, i.file_size) for i in z.infolist() if i.filename.endswith(".txt")]

    with ThreadPoolExecutor(LISTERS) as pool:
        return [m for found in pool.map(one, archives(path)) for m in found]


def base_name(member: str) -> str:
    return member.rsplit("/", 1)[-1].removesuffix(".txt")


def _records(z: zipfile.ZipFile, member: str):
    with io.TextIOWrapper(z.open(member), encoding="utf-8-sig", errors="replace", newline="") as text:
        yield from csv.reader(text)


def _header(record: list[str]) -> list[str]:
    return [c.strip() for c in record]


def _as_type(kind: pa.DataType, value: str | None):
    """(typed value, whether it fits); blank is null."""
    if value is None or pa.types.is_string(kind):
        return value, True
    value = value.strip()
    if not value:
        return None, True
    try:
        if pa.types.is_floating(kind):
            return float(value), True
        n = int(value)
        return (n, True) if -(1 << kind.bit_width - 1) <= n < 1 << kind.bit_width - 1 else (None, False)
    except ValueError:
        return None, False


def _batches(records, columns: list[str], kinds: list[pa.DataType]):
    """Record batches of the wanted columns, with the names of what did not fit."""
    header = _header(next(records, []))
    place = {c: i for i, c in enumerate(header)}
    at = [place.get(c) for c in columns]
    while some := [r for r in itertools.islice(records, RECORDS)]:
        some = [r for r in some if r]  # blank lines are no records
        bad = [[] if len(r) == len(header) else ["too long" if len(r) > len(header) else "too short"] for r in some]
        arrays = []
        for name, i, kind in zip(columns, at, kinds):
            typed = []
            for r, wrong in zip(some, bad):
                value, fits = _as_type(kind, None if i is None or i >= len(r) else r[i])
                typed.append(value)
                if not fits:
                    wrong.append(name)
            arrays.append(pa.array(typed, kind))
        arrays.append(pa.array([",".join(w) or None for w in bad], pa.string()))
        yield pa.RecordBatch.from_arrays(arrays, names=[*columns, BAD])


_ARROW = {"string": pa.string(), "integer": pa.int32(), "long": pa.int64(), "double": pa.float64(), "float": pa.float32(), "short": pa.int16()}


class MemberPartition(InputPartition):
    def __init__(self, archive: str, member: str):
        self.archive, self.member = archive, member


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, member: str, schema: T.StructType):
        self.path, self.member, self.schema = path, member, schema

    def partitions(self):
        return [MemberPartition(a, m) for a, m, _ in members(self.path) if base_name(m) == self.member] or [MemberPartition("", "")]

    def read(self, partition):
        fields = [f for f in self.schema.fields if f.name != BAD]
        if partition.archive:
            with _opened(partition.archive) as z:
                yield from _batches(_records(z, partition.member), [f.name for f in fields], [_ARROW[f.dataType.typeName()] for f in fields])


class Written(WriterCommitMessage):
    def __init__(self, archive: str):
        self.archive = archive


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, member: str, schema: T.StructType, overwrite: bool):
        self.path, self.member, self.schema, self.overwrite = path, member, schema, overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator):
        from pyspark import TaskContext

        store, inner = _store(self.path)
        store.create_dir(inner, recursive=True)
        # the attempt is part of the name: a repeated task never writes to another attempt's file; commit keeps one
        archive = f"{inner}/{self.job}-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}.zip"
        with store.open_output_stream(f"{archive}.part") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, \
                z.open(f"{self.member}.txt", "w", force_zip64=True) as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="") as text:
            rows = csv.writer(text)
            rows.writerow(self.schema.names)
            for batch in iterator:
                rows.writerows(zip(*(["" if v is None else repr(v) if isinstance(v, float) else v for v in c.to_pylist()] for c in batch.columns)))
        return Written(archive)

    def commit(self, messages):
        store, inner = _store(self.path)
        kept = {m.archive for m in messages if m is not None}
        for f in store.get_file_info(fs.FileSelector(inner)):
            if f.path.endswith(".zip") and self.overwrite:
                store.delete_file(f.path)
        for archive in sorted(kept):
            store.move(f"{archive}.part", archive)
        self._clean(store, inner)

    def abort(self, messages):
        self._clean(*_store(self.path))

    def _clean(self, store, inner):
        for f in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            if f.path.endswith(".part") and f"/{self.job}-" in f.path:
                store.delete_file(f.path)


class FeedArchive(DataSource):
    """Options: path, member (name without ``.txt``), declared (schema, as JSON, of the columns that are not text)."""

    @classmethod
    def name(cls) -> str:
        return "feed_archive"

    def schema(self) -> T.StructType:
        found = []
        for archive, member, _ in members(self.options["path"]):
            if base_name(member) == self.options["member"]:
                with _opened(archive) as z:
                    found += [c for c in _header(next(_records(z, member), [])) if c and c not in found]
        declared = {f.name: f for f in T.StructType.fromJson(json.loads(self.options["declared"])).fields} if self.options.get("declared") else {}
        fields = [declared.get(c, T.StructField(c, T.StringType())) for c in [*declared, *(c for c in found if c not in declared)]]
        return T.StructType([*fields, T.StructField(BAD, T.StringType())])

    def reader(self, schema):
        return ArchiveReader(self.options["path"], self.options["member"], schema)

    def writer(self, schema, overwrite):
        return ArchiveWriter(self.options["path"], self.options["member"], schema, overwrite)


def read_archive(spark: SparkSession, path: str, member: str, declared: str | None = None) -> DataFrame:
    """All records of ``member`` over the archives at ``path``, with the column ``_bad``; ``declared`` is a schema string."""
    spark.dataSource.register(FeedArchive)
    types = T._parse_datatype_string(declared).json() if declared else ""
    return spark.read.format("feed_archive").option("member", member).option("declared", types).load(path)


def write_archive(df: DataFrame, path: str, member: str, mode: str = "append") -> None:
    """One archive for each partition of ``df`` in the folder ``path``, the table as ``member`` with a header."""
    df.sparkSession.dataSource.register(FeedArchive)
    df.write.format("feed_archive").option("member", member).mode(mode).save(path)
