"""Files that hold one strict JSON object each, of any size: their lists are read as rows, an item at a time.

A file is one text, so one task passes over it; it holds a chunk and the value it is at, so memory does not grow with a list.  What is wrong with a
file is what :func:`strict_json.read_objects` says, but no file is too large.  Any store that Arrow's file systems know will do.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Collection, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.strict_json import _finite, _no_number, _pairs, _Refused, _whole
from .zip_members import opened

CHUNK = 1 << 20
#: Rows of one Arrow batch, and characters after which it is given away.
BATCH_ROWS, BATCH_CHARS = 1_000, 4 << 20
SCHEMA = "path string, list string, position long, text string, sha256 string, problem string"
_FIELDS = pa.schema([("path", pa.string()), ("list", pa.string()), ("position", pa.int64()), ("text", pa.string()), ("sha256", pa.string()), ("problem", pa.string())])
_DECODER = json.JSONDecoder(object_pairs_hook=_pairs, parse_constant=_no_number, parse_float=_finite, parse_int=_whole)
_SPACE = re.compile(r"[ \t\n\r]*")
_OF_NUMBERS = "0123456789.+-eE"
_NEAR_END = 16  # a word or an escape that the end of a chunk cuts begins in so many characters


class _Text:
    """A file's text as it is read; what was passed is dropped."""

    def __init__(self, file, chunk: int):
        self.file, self.chunk, self.buffer, self.at, self.ended = file, chunk, "", 0, False
        self.digest, self.decoder = sha256(), codecs.getincrementaldecoder("utf-8")()

    def more(self) -> None:
        """Reads on, as much again as is held, and never ends inside of a number."""
        parts = [self.buffer[self.at :]]
        while not self.ended:
            raw = self.file.read(max(self.chunk, len(parts[0])))
            self.digest.update(raw)
            self.ended = not raw
            parts.append(self.decoder.decode(raw, self.ended))
            if parts[-1] and parts[-1][-1] not in _OF_NUMBERS:
                break
        self.buffer, self.at = "".join(parts), 0

    def rest(self) -> None:
        while not self.ended:
            self.at = len(self.buffer)
            self.more()

    def next(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            self.at = _SPACE.match(self.buffer, self.at).end()
            if self.at < len(self.buffer) or self.ended:
                return self.buffer[self.at : self.at + 1]
            self.more()

    def take(self, char: str) -> None:
        if self.next() != char:
            raise ValueError(f"no {char}")
        self.at += 1

    def value(self) -> tuple[object, str]:
        """The next value and its text."""
        self.next()
        while True:
            try:
                value, end = _DECODER.raw_decode(self.buffer, self.at)
            except json.JSONDecodeError as wrong:
                if self.ended or not (wrong.msg.startswith("Unterminated string") or wrong.pos >= len(self.buffer) - _NEAR_END):
                    raise
                self.more()
            else:
                text, self.at = self.buffer[self.at : end], end
                return value, text

    def items(self) -> Iterator[tuple[object, str]]:
        """The items of the list that is next."""
        self.take("[")
        if self.next() == "]":
            self.at += 1
            return
        while True:
            yield self.value()
            if self.next() == "]":
                self.at += 1
                return
            self.take(",")


def _unpaired(value, text: str) -> bool:
    if "\\ud" not in text and "\\uD" not in text:
        return False
    try:
        json.dumps(value, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return True
    return False


def _object(text: _Text, lists: Collection[str]) -> Iterator[tuple]:
    """Rows of the items of ``lists``; returns the object with these lists empty."""
    if (first := text.next()) != "{":
        for _ in text.items() if first == "[" else [text.value()]:
            pass
        raise ValueError("more text") if text.next() else _Refused("not_object")
    text.at += 1
    names, members, unpaired = [], [], False
    while names or text.next() != "}":
        if text.next() != '"':
            raise ValueError("no name")
        name, written = text.value()
        text.take(":")
        names.append(name)
        unpaired = unpaired or _unpaired(name, written)
        if name in lists and text.next() == "[":
            for k, (value, item) in enumerate(text.items()):
                unpaired = unpaired or _unpaired(value, item)
                yield name, k, item, None, None
            members.append(f"{written}:[]")
        else:
            value, item = text.value()
            unpaired = unpaired or _unpaired(value, item)
            members.append(f"{written}:{item}")
        if text.next() == "}":
            break
        text.take(",")
    text.take("}")
    if len({*names}) < len(names):
        raise _Refused("duplicate_key")
    if text.next():
        raise ValueError("more text")
    if unpaired:
        raise _Refused("unpaired_surrogate")
    return f"{{{','.join(members)}}}"


def _told(text: _Text, lists: Collection[str]) -> Iterator[tuple]:
    """Rows of one file without its path; that of the object is the last."""
    whole = problem = None
    try:
        whole = yield from _object(text, lists)
    except UnicodeDecodeError:
        problem = "not_utf8"
    except _Refused as refused:
        problem = str(refused)
    except (ValueError, RecursionError):
        problem = "not_json"
    try:
        text.rest()
    except UnicodeDecodeError:
        problem = "not_utf8"
    yield None, None, whole, None if problem else text.digest.hexdigest(), problem


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)


def read_lists(files: DataFrame, root: str, lists: Collection[str], chunk: int = CHUNK) -> DataFrame:
    """Rows of the files (``path``, below ``root``): for each item of the members ``lists`` that are lists (list, position, text), and for each
    file the object with these lists empty as ``text`` and the file's ``sha256``, or ``problem``; its ``list`` is null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        rows, chars = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(f"{base}/{path}") as file:
                    for row in _told(_Text(file, chunk), lists):
                        rows.append((path, *row))
                        chars += len(row[2] or "")
                        if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                            yield _batch(rows)
                            rows, chars = [], 0
        if rows:
            yield _batch(rows)

    return files.select("path").mapInArrow(read, SCHEMA)
