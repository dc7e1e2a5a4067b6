"""Which folders make up a table: a log whose last entry for each part counts.

A table of parts is a folder with data folders in it and a log beside them. New
data is written to a folder of its own first; appending one file to the log then
puts it in the place of what was there, in one step. Readers see the table before
or after, never between, and a writer that is lost leaves the old rows. The log
has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mercato.sources import files

LOG = "_manifest"


@dataclass(frozen=True)
class Entry:
    """Where a part lies, below the table's folder, and its rows (``None`` if not counted)."""

    folder: str
    rows: int | None = None


class Manifest:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.log = f"{self.root}/{LOG}"

    def exists(self) -> bool:
        return files.exists(self.spark, self.log)

    def entries(self) -> dict[str, Entry]:
        """The last entry of each part; a log holds names, not rows, so it comes to the driver."""
        return {part: entry for part, (_, entry) in self._last().items()}

    def _last(self) -> dict[str, tuple[int, Entry]]:
        if not self.exists():
            return {}
        try:
            log = self.spark.read.schema("seq bigint, part string, folder string, rows bigint").parquet(self.log)
        except AnalysisException:  # the log's folder is there, its first file is not yet
            return {}
        last = log.groupBy("part").agg(F.max_by(F.struct("seq", "folder", "rows"), "seq").alias("e")).collect()
        return {r["part"]: (r["e"]["seq"], Entry(r["e"]["folder"], r["e"]["rows"])) for r in last}

    def new_folder(self, kind: str = "data") -> str:
        """The name of a folder for new data; Spark does not read such folders as part of ``root``."""
        return f"_{kind}/{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def commit(self, changes: Mapping[str, Entry]) -> None:
        """Let each part lie where ``changes`` says, all of them in one step."""
        if not changes:
            return
        seq = 1 + max((s for s, _ in self._last().values()), default=0)
        rows = [(seq, part, e.folder, e.rows) for part, e in changes.items()]
        frame = self.spark.createDataFrame(rows, "seq bigint, part string, folder string, rows bigint")
        frame.coalesce(1).write.mode("append").parquet(self.log)

    def forget(self, keep: Iterable[str] = (), kind: str = "data") -> list[str]:
        """Delete folders of ``kind`` that no part lies in; only when no reader of an older state is left."""
        live = {e.folder for e in self.entries().values()} | set(keep)
        gone = [f for n in files.folders(self.spark, self.path(f"_{kind}")) if (f := f"_{kind}/{n}") not in live]
        for folder in gone:
            files.delete(self.spark, self.path(folder))
        return gone
