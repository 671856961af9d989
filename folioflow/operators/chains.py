"""Ordered texts that are too large for one row: sorted in their partition, and hashed or written to files as they pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.zip_members import opened


def _sorted(pieces: DataFrame, group: list[str], order: list[str], text: Column, late: Column, changed: Callable[[Column], Column] | None = None) -> DataFrame:
    sort = pieces.repartition(*group).sortWithinPartitions(*group, *order)
    if changed:
        sort, text = sort.withColumn("text", text), changed(F.col("text"))
    section = F.concat_ws("/", *[F.col(x).cast("string") for x in order if x in ("rank", "start", "section")])
    return sort.select(*group, section.alias("section"), text.cast("binary").alias("text"), F.col("sep").cast("binary").alias("sep"), late.cast("binary").alias("late"))


def _runs(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[tuple, bool, list[bytes], bytes | None]]:
    """Bytes that follow each other, a section of a batch at a time: the group's key, whether it begins, its bytes, and what comes late."""
    key = last = None
    sep = b""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cuts = {0}
        for name in (*group, "section"):
            col = batch.column(name)
            cuts.update(x + 1 for x in pc.indices_nonzero(pc.not_equal(col.slice(1), col.slice(0, n - 1))).to_pylist())
        starts = sorted(cuts)
        for at, end in zip(starts, [*starts[1:], n], strict=True):
            this = tuple(batch.column(g)[at].as_py() for g in group)
            begins = this != key
            if begins:
                key, last, sep = this, None, b""
            section = batch.column("section")[at].as_py()
            told = [sep] if section == last else []
            last = section
            told.append(sep.join(batch.column("text").slice(at, end - at).to_pylist()))
            sep = batch.column("sep")[end - 1].as_py() or sep
            yield key, begins, told, batch.column("late")[end - 1].as_py()


def digests(pieces: DataFrame, group: list[str], order: list[str], text: Column, insert: str | None = None) -> DataFrame:
    """The group's columns and ``sha256`` of its pieces in order, ``text`` being asked after the sort.

    Rows of one ``section`` that follow each other are joined by ``sep`` of the row before them.  With ``insert``, what follows in ``late`` of
    the last row is hashed twice: as it stands, which is ``inner``, and after ``insert`` with ``{}`` replaced by that hash."""
    shown = _sorted(pieces, group, order, text, F.col("late") if insert else F.lit(None).cast("string"))
    names = [f"{g} string" for g in group]

    def told(key, whole, inner) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (*key, whole, inner)], names=[*group, "sha256", "inner"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = whole = inner = None
        for this, begins, parts, rest in _runs(batches, group):
            if begins:
                if key is not None:
                    yield told(key, whole.hexdigest(), inner)
                key, whole, inner = this, sha256(), None
            for part in parts:
                whole.update(part)
            if rest is not None:
                alone = whole.copy()
                alone.update(rest)
                inner = alone.hexdigest()
                whole.update(insert.replace("{}", inner).encode() + rest)
        if key is not None:
            yield told(key, whole.hexdigest(), inner)

    return shown.mapInArrow(chain, ", ".join([*names, "sha256 string", "inner string"]))


def written(pieces: DataFrame, order: list[str], text: Column, root: str, changed: Callable[[Column], Column] | None = None) -> DataFrame:
    """Writes the pieces of each ``path`` below ``root`` as one file, in order and joined as in :func:`digests`, as they pass; returns path, bytes and sha256.

    ``changed`` may change a text, which is worked out once, however often it is named.

    A file appears whole or not at all, as in :func:`zip_members.write_files`."""
    shown = _sorted(pieces, ["path"], order, text, F.lit(None).cast("string"), changed)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        runs = _runs(batches, ["path"])
        run = next(runs, None)
        while run:
            (path,), size, digest = run[0], 0, sha256()
            place = f"{base}/{path}"
            store.create_dir(place.rpartition("/")[0], recursive=True)
            beside = f"{place}.{uuid.uuid4().hex}"
            with store.open_output_stream(beside) as out:
                while run and run[0] == (path,):
                    for part in run[2]:
                        out.write(part)
                        digest.update(part)
                        size += len(part)
                    run = next(runs, None)
            store.move(beside, place)
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([size], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["path", "bytes", "sha256"])

    return shown.mapInArrow(put, "path string, bytes long, sha256 string")
