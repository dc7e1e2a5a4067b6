"""Shared helpers: staged tables in the shared folder and bounded Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one Python step holds at a time (a longer single text is taken alone).
SLICE_BYTES = 4 << 20

_scratch: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a scratch folder only where that is unset and the master is local."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if sc.applicationId not in _scratch:
            _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="mercato-llm-")
        base = _scratch[sc.applicationId]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between Spark and Python by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * SLICE_BYTES))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose ``column`` adds up to at most ``limit`` bytes, or one row that is longer."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def merged_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Like :func:`slices`, but small batches are joined up to ``limit`` bytes first."""
    held: list[pa.RecordBatch] = []
    total = 0
    for part in slices(batches, column, limit):
        size = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and total + size > limit:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(part)
        total += size
    if held:
        yield pa.concat_batches(held)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, each with underscores added until no column has its name in any case."""
    used = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(column: str) -> str:
    """The column's name for Spark, dots and all."""
    return "`" + column.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
