"""Immutable objects in a Parquet table whose writes commit as a whole.

A write puts its new rows into a batch of its own, and then claims the next number of the log with one rename that fails if
the number is taken.  Readers see batches of the log only: before the claim nothing of a write is visible, after it all is.  A writer
that was overtaken takes its batch back, looks at what has come in between, and tries again, so of two writers that both
bring the same key only one can win.  A write that fails leaves no batch behind.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.storage import to_append

ATTEMPTS = 5


class RivalWrite(RuntimeError):
    """Others have committed each time before this writer could."""


class Conflict(ValueError):
    """Another object has the same key."""


@dataclass(frozen=True)
class CommitLog:
    """Objects of ``schema`` below ``root``; ``key`` names them, ``payload`` is what may not differ for one key."""

    spark: SparkSession
    root: str
    schema: StructType
    key: str
    payload: str

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """The batches of the log in their order: the names of its entries are number-batch."""
        folder, files = self._path("_log"), self._files()
        names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
        found: dict[int, str] = {}
        for name in names:
            if not name.startswith((".", "_")):
                found[int(name)] = self._read(name)
        return [found[n] for n in sorted(found)]

    def _read(self, name: str) -> str:
        stream = self._files().open(self._path("_log", name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read(self) -> DataFrame:
        return self._rows(self.batches())

    def _rows(self, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/batch-{b}" for b in batches])

    def put(self, objects: DataFrame, attempts: int = ATTEMPTS) -> int:
        """Adds the objects that are new and returns how many; equal ones are no-ops, others under a known key raise :class:`Conflict`."""
        named = objects.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        for _ in range(attempts):
            seen, batch = self.batches(), uuid.uuid4().hex
            try:
                effects = to_append(self._rows(seen), named, self.key, self.payload)
                if effects.where("effect = 'conflict'").limit(1).count():
                    raise Conflict("another object has the same key")
                effects.where("effect = 'append'").select(*named.columns).write.parquet(f"{self.root}/batch-{batch}")
                n = self._rows([batch]).count()
                if n and not self._claim(len(seen) + 1, batch):
                    self._take_back(batch)
                    continue
            except BaseException:
                self._take_back(batch)
                raise
            if not n:
                self._take_back(batch)
            return n
        raise RivalWrite(f"{attempts} attempts were overtaken")

    def _take_back(self, batch: str) -> None:
        self._files().delete(self._path(f"batch-{batch}"), True)

    def _claim(self, number: int, batch: str) -> bool:
        """Whether this batch got the number: an entry is written beside the log and renamed, which fails where one is."""
        context = self.spark.sparkContext
        fs = context._jvm.org.apache.hadoop.fs
        entry, place = self._path(f"_entry-{batch}"), self._path("_log", f"{number:012d}")
        files = self._files()
        files.mkdirs(self._path("_log"))
        out = files.create(entry, False)
        out.write(batch.encode())
        out.close()
        try:
            none = context._gateway.new_array(getattr(fs, "Options$Rename"), 0)
            fs.FileContext.getFileContext(entry.toUri() if entry.toUri().getScheme() else files.getUri(), context._jsc.hadoopConfiguration()).rename(entry, place, none)
        except Exception as error:  # noqa: BLE001  py4j wraps it
            if "FileAlreadyExistsException" not in str(error):
                raise
            return False
        finally:
            files.delete(entry, False)
        return True
