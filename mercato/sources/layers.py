"""Parquet layers (silver, gold): read, full-overwrite write, publication of versions.

A plain layer is a folder of Parquet files. Overwriting writes beside it first and
then puts the new folder in its place by renaming, so a write that fails or is lost
leaves the old rows. A published layer keeps its versions in folders of their own,
and a log says which one counts (:mod:`mercato.sources.manifest`): one step, on any
store. ``read_layer`` reads both.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from mercato.operators.gate import Gate
from mercato.sources import files
from mercato.sources.manifest import Entry, Manifest

# Fixed value: the only part of a published layer.
WHOLE = "whole"
# Fixed value: where plain layers are written before they take their place (Spark does not read such folders).
STAGING = "_staging"


def layer_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The layer as last published, or the plain folder; one that was lost between the two renames is put back."""
    path = layer_path(root, name)
    if not files.exists(spark, path):
        restore(spark, root, name)
    entry = Manifest(spark, path).entries().get(WHOLE)
    return spark.read.parquet(path if entry is None else f"{path}/{entry.folder}")


def read_layer_optional(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return read_layer(spark, root, name)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(getattr(err, "getCondition", lambda: "")() or "") or "does not exist" in str(err):
            return None
        raise


def write_layer(
    df: DataFrame, root: str, name: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite"
) -> str:
    """Write a layer table (full refresh by default); returns its path. ``overwrite``
    may read what it replaces, and leaves it as it is until the new rows are complete."""
    spark, path = df.sparkSession, layer_path(root, name)
    beside = f"{root.rstrip('/')}/{STAGING}/{name}.{uuid.uuid4().hex}" if mode == "overwrite" else path
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(beside)
    if beside != path:
        old = f"{beside}.old"
        if files.exists(spark, path):
            files.rename(spark, path, old)
        if not files.rename(spark, beside, path):
            files.rename(spark, old, path)
            raise OSError(f"{beside} could not take the place of {path}")
        files.delete(spark, old)
    return path


def restore(spark: SparkSession, root: str, name: str) -> bool:
    """Put back a plain layer whose writer was lost between the two renames."""
    staging = f"{root.rstrip('/')}/{STAGING}"
    for folder in files.folders(spark, staging):
        if folder.startswith(f"{name}.") and folder.endswith(".old"):
            return files.rename(spark, f"{staging}/{folder}", layer_path(root, name))
    return False


def publish_layer(df: DataFrame, root: str, name: str, gate: Gate | None = None) -> str:
    """Write a new version of a layer and let it count, if ``gate`` passes; returns the version's path.

    The rows of the version are kept in the log. Older versions stay until ``forget_versions``."""
    spark = df.sparkSession
    table = Manifest(spark, layer_path(root, name))
    folder = table.new_folder()
    rows, counted = (gate or Gate()).observed(df)
    rows.write.parquet(table.path(folder))
    n = (gate or Gate()).check(name, counted)
    table.commit({WHOLE: Entry(folder, n)})
    return table.path(folder)


def published_rows(spark: SparkSession, root: str, name: str) -> int | None:
    """Rows of the published version, from the log; ``None`` for a plain layer."""
    entry = Manifest(spark, layer_path(root, name)).entries().get(WHOLE)
    return None if entry is None else entry.rows


def forget_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Delete the versions that no longer count, when no reader of them is left."""
    return Manifest(spark, layer_path(root, name)).forget()


def write_bucketed(df: DataFrame, root: str, name: str, table: str, key: str, buckets: int) -> str:
    """Write a layer as a catalog table bucketed and sorted by ``key``.

    Tables bucketed the same way on the join key are joined without shuffling
    either side. The frame is hash-partitioned into ``buckets`` first (the same
    hash as bucketing), so each task writes one file per bucket instead of one
    file per (task, bucket).
    """
    path = layer_path(root, name)
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return path
