"""A data source of the members of ZIP archives: ``spark.read.format("zip_members").load(folder)`` after :func:`register`.

Planning reads each archive's central directory only, and cuts its members into ranges of about ``split_bytes``; a partition is one
range, or several where there are more than ``MAX_TASKS``, so a large archive is read by many tasks and small ones don't become a task for each member.  A task seeks to its
first member and reads on, a chunk at a time, so memory does not grow with members.  Nothing is unpacked to disk.

Every member comes with its size, check sum and SHA-256, and what is wrong: not_zip (an archive that cannot be opened, no member), too_many,
unsafe_name, repeated_name, encrypted, link, method, overlap, damaged (the local header, the data, its length or its check sum
do not fit the directory).  Any store that Arrow's file systems know will do, as a URI or a local path.
"""

from __future__ import annotations

import io
import stat
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, header_offset long, stored long, bytes long, crc32 long, sha256 string, problem string"
SPLIT_BYTES, MAX_MEMBERS, CHUNK = 64 << 20, 100_000, 1 << 20
#: Tasks of one reading; more ranges than these share tasks.
MAX_TASKS = 256
_LOCAL = struct.Struct("<4s5H3I2H")


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    stored: int
    size: int
    crc: int
    method: int
    problem: str | None


@dataclass(frozen=True)
class Range:
    """Members from ``first`` to before ``end`` in the order of their places."""

    archive: str
    first: int
    end: int
    problem: str | None = None


@dataclass
class Ranges(InputPartition):
    """What one task reads.  It holds places only; the task reads the directories of its archives again."""

    ranges: tuple[Range, ...]

    def __post_init__(self):
        super().__init__(self.ranges[0].archive)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):  # as Hadoop writes it
        uri = f"file://{uri[5:]}"
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _safe(name: str) -> bool:
    return bool(name) and not name.startswith("/") and "\\" not in name and "\x00" not in name and not any(p in ("", ".", "..") for p in name.rstrip("/").split("/"))


def directory(file, most: int) -> tuple[list[Member], str | None]:
    """The members of an archive in the order of their places, and what is wrong with the whole."""
    try:
        small = file.size() <= CHUNK  # the end of a short file is looked for before its begin
        with zipfile.ZipFile(io.BytesIO(file.read()) if small else file) as z:
            infos = sorted(z.infolist(), key=lambda x: x.header_offset)
    except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
        return [], "not_zip"
    if len(infos) > most:
        return [], "too_many"
    seen: set[str] = set()
    out, end = [], 0
    for x in infos:
        name = x.orig_filename
        problem = (
            "unsafe_name" if not _safe(name) else "repeated_name" if name.casefold() in seen else "encrypted" if x.flag_bits & 1 else "link" if stat.S_ISLNK(x.external_attr >> 16)
            else "method" if x.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) else "overlap" if x.header_offset < end else None
        )
        seen.add(name.casefold())
        end = max(end, x.header_offset + _LOCAL.size + len(name.encode()) + x.compress_size)
        out.append(Member(name, x.header_offset, x.compress_size, x.file_size, x.CRC, x.compress_type, problem))
    return out, None


def _digest(file, m: Member) -> str | None:
    """The SHA-256 of a member's bytes; null if they don't fit its entry."""
    file.seek(m.offset)
    head = file.read(_LOCAL.size)
    if len(head) < _LOCAL.size:
        return None
    magic, _, flags, method, _, _, crc, stored, size, name_length, extra = _LOCAL.unpack(head)
    name = file.read(name_length)
    stated = (crc, stored, size) == (m.crc, m.stored, m.size) or flags & 8
    if magic != b"PK\x03\x04" or method != m.method or name.decode("utf-8" if flags & 0x800 else "cp437", "replace") != m.name or not stated:
        return None
    file.seek(m.offset + _LOCAL.size + name_length + extra)
    inflate = zlib.decompressobj(-15) if m.method else None
    left, done, crc, digest = m.stored, 0, 0, sha256()
    try:
        while left or (inflate and inflate.unconsumed_tail):
            raw = inflate.unconsumed_tail if inflate and inflate.unconsumed_tail else file.read(min(left, CHUNK))
            if not raw:
                return None
            if not (inflate and inflate.unconsumed_tail):
                left -= len(raw)
            part = inflate.decompress(raw, CHUNK) if inflate else raw
            done, crc = done + len(part), zlib.crc32(part, crc)
            digest.update(part)
            if done > m.size:
                return None
    except zlib.error:
        return None
    return digest.hexdigest() if done == m.size and crc == m.crc else None


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split, self.most = options["path"], int(options.get("split_bytes", SPLIT_BYTES)), int(options.get("max_members", MAX_MEMBERS))
        self.suffix = options.get("suffix", ".zip")

    def partitions(self) -> list[Ranges]:
        store, path = opened(self.path)
        info = store.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else [x for x in store.get_file_info(fs.FileSelector(path, recursive=True)) if x.type == fs.FileType.File and x.path.endswith(self.suffix)]
        out = []
        for f in sorted(files, key=lambda x: x.path):
            with store.open_input_file(f.path) as file:
                members, problem = directory(file, self.most)
            if problem or not members:
                out.append(Range(f.path, 0, 0, problem))
            first = size = 0
            for k, m in enumerate(members):
                size += m.stored
                if size >= self.split or k + 1 == len(members):
                    out.append(Range(f.path, first, k + 1))
                    first, size = k + 1, 0
        each = -(-len(out) // MAX_TASKS) or 1
        return [Ranges(tuple(out[k : k + each])) for k in range(0, len(out), each)]

    def read(self, partition: Ranges) -> Iterator[tuple]:
        store, _ = opened(self.path)
        for archive, ranges in groupby(partition.ranges, lambda r: r.archive):
            with store.open_input_file(archive) as file:
                members = None
                for r in ranges:
                    if r.problem:
                        yield (archive, None, None, None, None, None, None, r.problem)
                    if r.first < r.end and members is None:
                        members, _ = directory(file, self.most)
                    for m in members[r.first : r.end] if members else ():
                        digest = None if m.problem else _digest(file, m)
                        yield (archive, m.name, m.offset, m.stored, m.size, m.crc, digest, m.problem or (None if digest else "damaged"))


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipMembers)


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Writes (path, content) below ``root`` from the tasks that have them; returns path, bytes and sha256 of each.

    A file appears whole or not at all: it is written beside its place and moved, so a task that is run again does no harm."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(root)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                place = f"{base}/{path}"
                store.create_dir(place.rpartition("/")[0], recursive=True)
                beside = f"{place}.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    out.write(content)
                store.move(beside, place)
            yield pd.DataFrame({"path": batch["path"], "bytes": batch["content"].map(len), "sha256": batch["content"].map(lambda b: sha256(b).hexdigest())})

    return files.select("path", "content").mapInPandas(put, "path string, bytes long, sha256 string")


def archive_facts(members: DataFrame) -> DataFrame:
    """archive, members, bytes and the first problem of each archive."""
    return members.groupBy("archive").agg(F.count("member").alias("members"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.min("problem").alias("problem"))
